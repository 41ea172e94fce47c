"""Latest-wins deduplication.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ingested_at DESC, tie DESC) = 1``.
Catalyst turns the rank filter into a *partial* ``WindowGroupLimit`` that runs before the
shuffle, so every map task keeps at most one row per key: a key that holds a third of all
raw rows (a symbol re-ingested many times) is cut down map-side and never lands whole in
one reducer. The shuffle is hashed on the full key (entity + date), which spreads a hot
entity over its dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], order_by: str = "ingested_at",
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row per ``keys``.

    A NULL ``order_by`` sorts last (an unknown ingest time never beats a known one). The
    reference orders by ingest time alone, so equal times pick an arbitrary row; the
    ``tie_breakers`` (descending) make the choice deterministic.
    """
    order = [F.col(order_by).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def error_free(df: DataFrame, error_col: str = "error") -> DataFrame:
    """``WHERE error IS NULL`` (P3). Tolerates frames that never had an error column."""
    if error_col not in df.columns:
        return df
    return df.filter(F.col(error_col).isNull())
