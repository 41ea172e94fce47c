"""Reshaping of extracted frames into the raw-table layout.

A multi-ticker download arrives wide: a date column plus one block of fields per ticker.
Here a block is a struct column named by the ticker with the fields ``Open, High, Low,
Close, Adj Close, Volume``. Wide -> long explodes an array of (ticker, block) pairs in a single pass
over the frame (no per-ticker filter-and-union loop, so the input is read once).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Field names of a downloaded price block, and the normalised column order.
WIDE_FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
PRICE_LONG_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume"]
COLUMN_RENAMES = {"adj close": "adj_close"}

PRICE_LONG_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
    *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "adj_close")],
    T.StructField("volume", T.LongType()),
])
BENCH_LONG_SCHEMA = T.StructType([
    T.StructField("series_ticker", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("value", T.DoubleType()),
])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def present_tickers(wide: DataFrame, tickers: Sequence[str]) -> list[str]:
    """Requested tickers that have a block in the frame; absent ones are warned about."""
    have = set(wide.columns)
    present = [t for t in tickers if t in have]
    for t in tickers:
        if t not in have:
            log.warning("the download has no block for %s", t)
    return present


def normalise_price_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, ``adj close`` -> ``adj_close``, fixed column order."""
    renamed = df.toDF(*[COLUMN_RENAMES.get(c.lower(), c.lower()) for c in df.columns])
    return renamed.select(*PRICE_LONG_COLUMNS)


def drop_incomplete(df: DataFrame, cols: Sequence[str] = ("close", "volume")) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL or NaN."""
    return df.dropna(how="any", subset=list(cols))


#: blocks that are zipped with their tickers in one expression
CHUNK = 500


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _blocks(wide: DataFrame, tickers: Sequence[str], date_col: str, field: str | None = None) -> DataFrame:
    """Rows ``(ticker, day, block)`` of the tickers' blocks, or of one field of them.

    The tickers are one literal array and the blocks one array of columns, zipped: a few nodes
    per ticker in the plan, so a download of thousands of tickers is planned in seconds. They are
    dealt in chunks, each an array of its own inside one pass over the frame. The blocks have one type.
    """
    chunks = []
    for at in range(0, len(tickers), CHUNK):
        some = tickers[at:at + CHUNK]
        values = [f"{_q(t)}.{_q(field)}" if field else _q(t) for t in some]
        chunks.append(f"arrays_zip(array({', '.join(map(_text, some))}), array({', '.join(values)}))")
    pairs = f"explode(flatten(array({', '.join(chunks)}))) AS pair"
    return wide.selectExpr(f"{_q(date_col)} AS day", pairs).select(
        F.col("pair.0").alias("ticker"), "day", F.col("pair.1").alias("block"))


def _by_type(wide: DataFrame, tickers: Sequence[str]) -> list[list[str]]:
    """The tickers whose blocks have the same type together (mostly all)."""
    types: dict[str, list[str]] = {}
    blocks = {f.name: f.dataType.json() for f in wide.schema.fields}
    for t in tickers:
        types.setdefault(blocks[t], []).append(t)
    return list(types.values())


def prices_long(wide: DataFrame, tickers: Sequence[str], date_col: str = "Date") -> DataFrame:
    """Wide OHLCV blocks -> rows ``(symbol, date, open, high, low, close, adj_close, volume)``
    (S1, S2, S6, S7, U1). No block at all gives an empty frame with the schema."""
    present = present_tickers(wide, tickers)
    if not present:
        log.error("the download has none of the requested price blocks")
        return wide.sparkSession.createDataFrame([], PRICE_LONG_SCHEMA)
    # blocks of another type (fields, a volume of doubles) are a pass of their own
    parts = [_blocks(wide, own, date_col).select(
        F.col("ticker").alias("symbol"), F.col("day").alias("Date"),
        *[F.col(f"block.{_q(f)}").alias(f) for f in WIDE_FIELDS]) for own in _by_type(wide, present)]
    return drop_incomplete(normalise_price_columns(reduce(DataFrame.unionByName, parts)),
                           ["close", "volume"])


def prices_single(df: DataFrame, symbol: str) -> DataFrame:
    """A one-ticker download (flat columns): the symbol is attached as a constant (S3)."""
    out = df.withColumn("symbol", F.lit(symbol))
    return drop_incomplete(normalise_price_columns(out), ["close", "volume"])


def benchmark_long(wide: DataFrame, tickers: Sequence[str], date_col: str = "Date",
                   field: str = "Close") -> DataFrame:
    """Close of each series block -> rows ``(series_ticker, date, value)``."""
    present = present_tickers(wide, tickers)
    if not present:
        log.error("the download has none of the requested series")
        return wide.sparkSession.createDataFrame([], BENCH_LONG_SCHEMA)
    parts = [_blocks(wide, own, date_col, field).select(
        F.col("ticker").alias("series_ticker"), F.col("day").alias("date"),
        F.col("block").alias("value")) for own in _by_type(wide, present)]
    return drop_incomplete(reduce(DataFrame.unionByName, parts), ["value"])


# The lower-cased names that mark the value and the date of a one-series download.
SERIES_VALUE_NAMES = {"close", "adj close", "adj_close"}
SERIES_DATE_NAMES = {"date", "datetime", "index"}


def resolve_series_columns(columns: Sequence[str]) -> tuple[str, str] | None:
    """(date column, value column) of a one-series download (S9), by lower-cased name; of
    several the last one. None unless both are there."""
    by_role = [[name for name in columns if name.lower() in names]
               for names in (SERIES_DATE_NAMES, SERIES_VALUE_NAMES)]
    return (by_role[0][-1], by_role[1][-1]) if all(by_role) else None


def benchmark_single(df: DataFrame, ticker: str) -> DataFrame:
    """A one-series download -> ``(series_ticker, date, value)``; falls back to the first two
    columns when no date/close names are found (S9, S10)."""
    resolved = resolve_series_columns(df.columns)
    date_c, value_c = resolved if resolved else (df.columns[0], df.columns[1])
    out = df.select(F.lit(ticker).alias("series_ticker"), F.col(_q(date_c)).alias("date"),
                    F.col(_q(value_c)).alias("value"))
    return drop_incomplete(out, ["value"])


def stamp(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """``ingested_at`` = one driver-side local timestamp for the whole batch."""
    now = now or dt.datetime.now()
    # from the ISO text: a wall-clock value, independent of process and session time zones
    return df.withColumn("ingested_at", F.to_timestamp_ntz(F.lit(now.isoformat(sep=" "))))
