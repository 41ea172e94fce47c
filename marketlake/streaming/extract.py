"""From the shape of an extract to rows of a raw table, as one step of a load.

Reshape, drop incomplete rows, keep the period and the universe asked for, stamp: what a
landed download goes through before it is appended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from marketlake.operators.filters import restrict, select_range
from marketlake.sources import documents, reshape

#: shape of an extract -> the raw table it feeds
SHAPES = {"wide-prices": "stock_prices_daily", "single-prices": "stock_prices_daily",
          "wide-benchmarks": "benchmark_series_daily", "single-benchmark": "benchmark_series_daily",
          "profiles": "company_info"}


def extract_rows(df: DataFrame, shape: str, symbols: Sequence[str], start=None, end=None,
                 period: str = "max", as_of=None, now: dt.datetime | None = None) -> DataFrame:
    """Rows of the shape's raw table, but for the run id that the load adds.

    ``symbols`` is the universe: the blocks taken from a wide frame, the one symbol of a single
    download, the profiles kept. Dates are cut as in :func:`select_range`; ``max`` keeps all.
    """
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape!r}; expected one of {sorted(SHAPES)}")
    if shape.startswith("single") and len(symbols) != 1:
        raise ValueError("a single download has one symbol")
    if shape == "profiles":
        # a profile carries the time of its own fetch, or the load's
        stamped = df if "ingested_at" in df.columns else reshape.stamp(df, now)
        rows = documents.company_from_json(stamped)
        return restrict(rows, "symbol", symbols) if symbols else rows
    build: dict[str, Callable[[], DataFrame]] = {
        "wide-prices": lambda: reshape.prices_long(df, symbols),
        "single-prices": lambda: reshape.prices_single(df, symbols[0]),
        "wide-benchmarks": lambda: reshape.benchmark_long(df, symbols),
        "single-benchmark": lambda: reshape.benchmark_single(df, symbols[0]),
    }
    rows = build[shape]()
    if (start and end) or period != "max":
        rows = select_range(rows, start, end, period, as_of)
    return reshape.stamp(rows, now)
