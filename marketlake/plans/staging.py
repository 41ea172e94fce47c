"""Staging models M1-M3: latest version per key plus per-entity change metrics.

Physical shape: a hash exchange on the version key (entity, date) after a map-side partial
top-1, then one exchange on the entity for the change windows. The second exchange moves
deduplicated rows only, at most one per entity and date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedup import error_free, latest_version
from marketlake.operators.windows import (diff, entity_window, moving_avg, pct_change,
                                          price_change, range_volatility, segmented)

PRICE_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume",
                 "ingested_at", "source_run_id"]

COMPANY_COLUMNS = [
    "symbol", "company_name", "sector", "industry", "market_cap", "enterprise_value",
    "pe_ratio", "forward_pe", "peg_ratio", "price_to_book", "dividend_yield", "beta",
    "fifty_two_week_high", "fifty_two_week_low", "fifty_day_average",
    "two_hundred_day_average", "shares_outstanding", "float_shares", "employees", "country",
    "city", "website", "business_summary", "ingested_at",
]

BENCHMARK_COLUMNS = ["series_ticker", "date", "value", "ingested_at", "source_run_id"]


def _windowed(latest: DataFrame, key: str, reach: int, by_year: bool):
    """The rows and the window of an entity's metrics; by year, with the rows that reach into it."""
    if not by_year:
        return latest, entity_window([key])
    return segmented(latest, [key], reach), entity_window([key, "segment"])


def _own_rows(staged: DataFrame, columns: Sequence[str]) -> DataFrame:
    if "carried" in staged.columns:
        staged = staged.filter(~F.col("carried"))
    return staged.select(*columns)


def stg_stock_prices(raw: DataFrame, tie_breakers: Sequence[str] = ("source_run_id",),
                     by_year: bool = False) -> DataFrame:
    """M1: newest ingest per (symbol, date), then daily_return, daily_volatility,
    price_change and the 5-row volume average. One ``LAG`` serves every use.

    ``by_year`` runs the windows by symbol and year (few symbols with long histories)."""
    latest = latest_version(raw, ["symbol", "date"], "ingested_at", tie_breakers)
    latest, w = _windowed(latest, "symbol", 4, by_year)
    return _own_rows(latest.select(
        *(["carried"] if by_year else []),
        *PRICE_COLUMNS,
        pct_change("close", w).alias("daily_return"),
        range_volatility("high", "low", "close").alias("daily_volatility"),
        price_change("close", "open").alias("price_change"),
        moving_avg("volume", w, 5).alias("volume_ma5"),
    ), [*PRICE_COLUMNS, "daily_return", "daily_volatility", "price_change", "volume_ma5"])


def stg_company_info(raw: DataFrame) -> DataFrame:
    """M2: newest *error-free* snapshot per symbol. The error filter runs before the rank,
    so a failed refresh falls back to the last good snapshot; ``source_run_id`` is dropped."""
    latest = latest_version(error_free(raw), ["symbol"], "ingested_at", ("source_run_id",))
    return latest.select(*COMPANY_COLUMNS)


def stg_benchmark_series(raw: DataFrame, tie_breakers: Sequence[str] = ("source_run_id",),
                         by_year: bool = False) -> DataFrame:
    """M3: newest ingest per (series, date), then the change and percent change against the
    series' previous row (its own calendar, not the previous day). ``by_year`` as for prices."""
    latest = latest_version(raw, ["series_ticker", "date"], "ingested_at", tie_breakers)
    latest, w = _windowed(latest, "series_ticker", 1, by_year)
    return _own_rows(latest.select(
        *(["carried"] if by_year else []),
        *BENCHMARK_COLUMNS,
        diff("value", w).alias("daily_change"),
        pct_change("value", w).alias("pct_change"),
    ), [*BENCHMARK_COLUMNS, "daily_change", "pct_change"])
