"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, n: int = 30, symbol=None, keys: Sequence[str] = ("symbol",),
                order: str = "date") -> DataFrame:
    """The newest ``n`` rows (trading rows, not calendar days) per entity (L2).

    For one entity this is ``WHERE symbol = ? ORDER BY date DESC LIMIT n``
    (``TakeOrderedAndProject``). For all entities at once it is a per-entity
    ``row_number() <= n``: a partial ``WindowGroupLimit`` trims each map task before the
    shuffle, and the answer is computed for every symbol in one distributed job.
    """
    if not 1 <= n:
        raise ValueError("n must be positive")
    if symbol is not None:
        return (df.filter(F.col(keys[0]) == F.lit(symbol))
                  .orderBy(F.col(order).desc_nulls_last()).limit(n))
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_n(df: DataFrame, n: int, *order_cols) -> DataFrame:
    """``ORDER BY ... LIMIT n`` with an explicit order."""
    return df.orderBy(*order_cols).limit(n)
