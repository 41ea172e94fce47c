"""Predicates: screener filters, recent windows, periods, universes, incremental (P4-P6, S4,
S5, S15, K12). All are plain ``filter`` calls so Catalyst pushes them into the scan."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.expressions import date_value

ALL = "All"

# Cap choices offered by the screener (Micro Cap is not offered).
SCREENER_CAP_CHOICES = ["All", "Mega Cap", "Large Cap", "Mid Cap", "Small Cap"]

# Period vocabulary of the price source.
PERIODS = ["1d", "5d", "1mo", "3mo", "6mo", "1y", "2y", "5y", "10y", "ytd", "max"]


def screen(df: DataFrame, sector: str = ALL, cap: str = ALL, symbol=ALL) -> DataFrame:
    """AND of the optional equality filters; ``All`` means no filter."""
    if sector != ALL:
        df = df.filter(F.col("sector") == F.lit(sector))
    if cap != ALL:
        df = df.filter(F.col("market_cap_category") == F.lit(cap))
    if symbol != ALL:
        df = df.filter(F.col("symbol") == F.lit(symbol))
    return df


def recent(df: DataFrame, as_of, days: int = 30, date_col: str = "date") -> DataFrame:
    """``date >= DATEADD(day, -days, as_of)``: trailing *calendar* days (P5)."""
    return df.filter(F.col(date_col) >= F.date_sub(date_value(as_of), days))


def period_start(period: str, as_of) -> Column | None:
    """First date (exclusive) covered by a period ending at ``as_of`` (S5); None for ``max``.

    ``Nd`` counts days, ``Nmo`` months, ``Ny`` years; ``ytd`` starts at 1 January.
    """
    a = date_value(as_of)
    if period == "max":
        return None
    if period == "ytd":
        return F.date_sub(F.trunc(a, "year"), 1)
    m = re.fullmatch(r"(\d+)(d|mo|y)", period)
    if not m or period not in PERIODS:
        raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")
    n, unit = int(m.group(1)), m.group(2)
    if unit == "d":
        return F.date_sub(a, n)
    return F.add_months(a, -n * (12 if unit == "y" else 1))


def select_range(df: DataFrame, start=None, end=None, period: str = "1y", as_of=None,
                 date_col: str = "date") -> DataFrame:
    """Date range when *both* bounds are given (``start <= date < end``), else a period
    ending at ``as_of`` (S4). A single bound is ignored, as in the reference."""
    d = F.col(date_col)
    if start and end:
        return df.filter((d >= date_value(start)) & (d < date_value(end)))
    if as_of is None:
        raise ValueError("as_of is required for period selection (never read from the clock)")
    lower = period_start(period, as_of)
    cond = d <= date_value(as_of)
    if lower is not None:
        cond = cond & (d > lower)
    return df.filter(cond)


def restrict(df: DataFrame, col: str, universe) -> DataFrame:
    """Restrict to a configured universe (S15): a literal ``IN`` list for a Python list, a
    left-semi join for a DataFrame of keys (no size limit, no driver round trip)."""
    if isinstance(universe, DataFrame):
        return df.join(universe.select(F.col(universe.columns[0]).alias(col)), col, "left_semi")
    return df.filter(F.col(col).isin(list(universe)))


def incremental(df: DataFrame, watermark, date_col: str = "date") -> DataFrame:
    """Rows strictly above the high-water mark (K12). ``watermark`` may be a string, a date
    or a scalar-subquery Column; NULL (no watermark yet) keeps everything."""
    wm = watermark if isinstance(watermark, Column) else F.lit(watermark)
    wm = F.to_date(wm)
    return df.filter(wm.isNull() | (F.col(date_col) > wm))



def arrived_since(df: DataFrame, mark, overlap_days: int = 0, ts_col: str = "ingested_at") -> DataFrame:
    """Rows that arrived after the ingest mark, whatever their date.

    A correction of an old day lies below the date's high-water mark but above this one. ``overlap_days``
    reaches back for loads that were stamped before the mark, or with the same stamp, but landed after it:
    consumers replace what they derive, so rows seen twice do no harm. NULL (no mark yet)
    keeps everything. ``mark`` is a string, a timestamp or a Column.
    """
    m = mark if isinstance(mark, Column) else F.lit(mark)
    m = m.cast("timestamp_ntz") - F.make_dt_interval(F.lit(overlap_days))
    return df.filter(m.isNull() | (F.col(ts_col) > m))


def late_rows(df: DataFrame, date_mark, ingest_mark, date_col: str = "date") -> DataFrame:
    """Rows that arrived since the ingest mark for dates up to the date mark: what
    :func:`incremental` alone would drop (K12)."""
    d = date_mark if isinstance(date_mark, Column) else F.lit(date_mark)
    return arrived_since(df, ingest_mark).filter(F.col(date_col) <= F.to_date(d))
