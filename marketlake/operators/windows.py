"""Per-entity window metrics.

Every window is partitioned by an entity key (symbol or series); none is global. After
latest-wins dedup an entity holds at most one row per date, so a window partition is
bounded by the length of the calendar, not by data volume. Metrics that share a partition
and order are evaluated by one ``Window`` operator over one sort. :func:`segmented` cuts few,
long series into years, for as many tasks as there are years of data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions.expressions import col_, safe_div


def entity_window(keys: Sequence[str] = ("symbol",), order: str = "date",
                  descending: bool = False) -> WindowSpec:
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    return Window.partitionBy(*keys).orderBy(o)


#: segment of rows without a date, after all years
NO_DATE = 1_000_000


def segmented(df: DataFrame, keys: Sequence[str] = ("symbol",), reach: int = 1,
              order: str = "date") -> DataFrame:
    """Rows for windows by entity and year, with the ``reach`` rows that precede each year carried in.

    A few entities with long series (five benchmarks, 25 brands) give an entity window few tasks,
    however long they are. Here every row gets ``segment``, its year, and each segment also gets copies (``carried``) of
    the entity's last ``reach`` rows before it, from one or more earlier years. A window over
    (``keys``, ``segment``) that looks back at most ``reach`` rows (1 for LAG, n - 1 for a mean over n) has the
    entity window's result on the rows that aren't carried; drop the others after it.

    The carried rows are found from the segments' ends alone: at most ``reach`` rows of each are
    shuffled again, with one count a segment. Keys are not null, dates of an entity distinct.
    """
    rows = df.withColumn("segment", F.coalesce(F.year(order), F.lit(NO_DATE)))
    own = [*keys, "segment"]
    by_entity = Window.partitionBy(*keys).orderBy("segment")
    sizes = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n")).select(
        *own, "_n", F.row_number().over(by_entity).alias("_index"),
        F.sum("_n").over(running(by_entity)).alias("_upto"))
    newest = Window.partitionBy(*own).orderBy(F.col(order).desc_nulls_first())
    ends = rows.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= reach)
    later = sizes.select(*keys, F.col("_index").alias("_target"), F.col("segment").alias("_segment"),
                         (F.col("_upto") - F.col("_n")).alias("_before"))
    carried = (ends.join(sizes, own)
               .withColumn("_target", F.explode(F.sequence(F.col("_index") + 1, F.col("_index") + reach)))
               .join(later, [*keys, "_target"])
               # rows between this one and the segment's first
               .filter(F.col("_before") - (F.col("_upto") - F.col("_back")) <= reach))
    return rows.withColumn("carried", F.lit(False)).unionByName(
        carried.select(*[F.col("_segment").alias("segment") if c == "segment" else c for c in rows.columns],
                       F.lit(True).alias("carried")))


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def prev(c, w: WindowSpec) -> Column:
    return F.lag(col_(c)).over(w)


def diff(c, w: WindowSpec) -> Column:
    """``x - LAG(x)``."""
    return col_(c) - prev(c, w)


def pct_change(c, w: WindowSpec) -> Column:
    """``(x - LAG(x)) / NULLIF(LAG(x), 0)`` over the previous *row*."""
    p = prev(c, w)
    return safe_div(col_(c) - p, p)


def moving_avg(c, w: WindowSpec, n: int) -> Column:
    """Average over the last ``n`` rows including the current one; short at the start."""
    return F.avg(col_(c)).over(w.rowsBetween(-(n - 1), Window.currentRow))


def range_volatility(high, low, close) -> Column:
    """``(high - low) / NULLIF(close, 0)``."""
    return safe_div(col_(high) - col_(low), close)


def price_change(close, open_) -> Column:
    """``close - open``."""
    return col_(close) - col_(open_)


def base100(c, w: WindowSpec) -> Column:
    """``x / first(x) * 100`` over the displayed span.

    The first value is used even when it is NULL (the result is then NULL), like
    ``series / series.iloc[0]``; a zero first value also gives NULL.
    """
    first = F.first(col_(c), ignorenulls=False).over(running(w))
    return F.try_divide(col_(c), first) * F.lit(100.0)


def cumulative_return(c, w: WindowSpec) -> Column:
    """``cumprod(1 + fillna(r, 0)) - 1`` (W11); includes the first displayed row's own return."""
    return F.product(F.lit(1.0) + F.coalesce(col_(c), F.lit(0.0))).over(running(w)) - F.lit(1.0)
