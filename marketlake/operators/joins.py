"""Equi left-outer joins of the models.

No side is hinted. Every join is planned as a shuffle join, and Spark itself turns it into
a broadcast where the measured bytes of a side lie under the session's threshold
(``spark.sql.autoBroadcastJoinThreshold``, at run time
``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_company(prices: DataFrame, company: DataFrame) -> DataFrame:
    """prices LEFT JOIN company ON symbol.

    No hint: the company dimension grows with the number of listed symbols. Prices arrive
    hash-partitioned by symbol from their per-symbol window, so a sort-merge join reuses
    that partitioning and only the dimension is shuffled; AQE switches to a broadcast when
    the dimension's measured shuffle output is small.
    """
    return prices.join(company, "symbol", "left")


def join_benchmarks(prices: DataFrame, bench_by_date: DataFrame) -> DataFrame:
    """prices LEFT JOIN benchmarks_pivot ON date.

    The pivot holds one row per date; its measured size decides between a broadcast and a
    shuffle join.
    """
    return prices.join(bench_by_date, "date", "left")


def dim_with_fact(dim: DataFrame, fact_by_symbol: DataFrame) -> DataFrame:
    """dim LEFT JOIN (fact aggregated per symbol) ON symbol (J3): stocks without facts stay."""
    return dim.join(fact_by_symbol, "symbol", "left")


def semi_by(df: DataFrame, keys_df: DataFrame, key: str = "symbol", nulls: bool = False) -> DataFrame:
    """``WHERE key IN (SELECT key FROM keys_df)`` as a left-semi join (J5). With ``nulls`` a
    null is a key like any other and meets a null of ``keys_df``; in SQL's ``IN`` it meets none."""
    if not nulls:
        return df.join(keys_df.select(key), key, "left_semi")
    met = F.col(f"rows.{key}").eqNullSafe(F.col(f"shown.{key}"))
    return df.alias("rows").join(keys_df.select(key).alias("shown"), met, "left_semi")
