"""Dashboard queries B0-B5, answered for every symbol in one distributed job.

The reference pulls one symbol at a time into pandas and post-processes it on one
machine; here the top-N, base-100 index, cumulative return and statistics are per-symbol
windows and aggregates, so all symbols are computed at once (the one-symbol form is a
filter on top and plans as ``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.expressions import (cap_category, pct_fixed, pct_label, round_even,
                                              stock_label, thousands)
from marketlake.operators import aggregates as agg
from marketlake.operators.filters import ALL, recent, screen
from marketlake.operators.joins import dim_with_fact, semi_by
from marketlake.operators.topk import latest_rows
from marketlake.operators.windows import base100, cumulative_return, entity_window

# Decimal places kept by the statistics outputs (sums of doubles depend on summation order).
STAT_DIGITS = 6


def home_kpis(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Distinct stocks, latest date, total fact rows as one row (A3 + A4 + A5).

    The stock count is a scalar subquery, so no cross join is needed.
    """
    n_stocks = dim.select(F.count_distinct("symbol")).scalar()
    return fact.agg(F.max("date").alias("latest_date"),
                    F.count(F.lit(1)).alias("total_records")) \
               .select(n_stocks.alias("total_stocks"), "latest_date", "total_records")


def home_kpi_labels(kpis: DataFrame) -> DataFrame:
    """Display strings of B0: 'N/A' for no date, thousands separators for the count."""
    return kpis.select(
        F.col("total_stocks").cast("string").alias("total_stocks"),
        F.coalesce(F.col("latest_date").cast("string"), F.lit("N/A")).alias("latest_data"),
        thousands("total_records").alias("total_records"),
    )


def stock_summary(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """A2 + J3 + L1: one row per stock of the dimension with its fact aggregates.

    ``GROUP BY symbol, company_name, sector, industry`` over ``dim LEFT JOIN fact`` equals a
    per-symbol pre-aggregation of the fact joined to the dimension, because the symbol is
    unique in the dimension (checked by Q2). The pre-aggregation runs on the fact's existing
    symbol partitioning, so the big side is aggregated before any join and never shuffled.
    """
    by_symbol = agg.fact_by_symbol(fact)
    out = dim_with_fact(dim.select("symbol", "company_name", "sector", "industry"), by_symbol)
    return out.select(
        "symbol", "company_name", "sector", "industry", "market_cap_category", "latest_date",
        _r("avg_close"), _r("avg_return"), _r("avg_alpha"),
    ).orderBy("symbol")


def screener(dim: DataFrame, fact: DataFrame, sector: str = ALL, cap: str = ALL,
             symbol=ALL) -> DataFrame:
    """The summary with the optional sector / cap / symbol filters."""
    return screen(stock_summary(dim, fact), sector, cap, symbol)


def screener_display(screened: DataFrame) -> DataFrame:
    """Display projection of B3: close rounded half-even to 2, returns as percent strings."""
    return screened.select(
        "symbol", "company_name", "sector", "market_cap_category", "latest_date",
        round_even("avg_close", 2).alias("avg_close"),
        pct_label("avg_return").alias("avg_return"),
        pct_label("avg_alpha").alias("avg_alpha"),
    )


def screener_count(screened: DataFrame) -> DataFrame:
    """A10: number of stocks shown."""
    return screened.agg(F.count(F.lit(1)).alias("n_stocks"))


def price_trend(facts: DataFrame, screened: DataFrame, as_of=None, days: int = 30,
                nulls: bool = False) -> DataFrame:
    """The screened symbols' rows of the trailing ``days`` calendar days, newest first.

    ``screened`` is any frame with the symbols to show; :func:`screened_symbols` gives them
    from the dimension alone. With ``nulls`` a null among them shows the rows without a symbol.
    ``as_of`` defaults to the latest loaded date (a scalar
    subquery), never the clock.
    """
    if as_of is None:
        as_of = facts.select(F.max("date")).scalar()
    rows = semi_by(facts.select("symbol", "date", "close", "daily_return"), screened, nulls=nulls)
    return recent(rows, as_of, days).orderBy(F.col("date").desc())


def screened_symbols(dim: DataFrame, sector: str = ALL, cap: str = ALL, symbol=ALL) -> DataFrame:
    """The symbols a screener selection shows. Sector and cap band belong to the company, so
    the fact isn't needed; a symbol without facts has no rows to show either."""
    banded = dim.withColumn("market_cap_category", cap_category("market_cap"))
    return screen(banded, sector, cap, symbol).select("symbol")


COMPARISON_COLUMNS = ["symbol", "date", "close", "daily_return", "sp500_value", "sp500_return",
                      "alpha_vs_sp500", "vix_value"]


def benchmark_comparison(fact: DataFrame, n: int = 30, symbol=None) -> DataFrame:
    """B1: the latest ``n`` rows of each symbol, re-sorted ascending, with the base-100
    index of the stock and of the S&P 500 and both cumulative returns (L2, L3, W10, W11)."""
    rows = latest_rows(fact.select(*COMPARISON_COLUMNS), n, symbol)
    w = entity_window(["symbol"])
    # Not rounded: the index is one division, and the running product is a left fold in
    # date order, so both are exact (rounding could split values sitting on a tie).
    return rows.select(
        *COMPARISON_COLUMNS,
        base100("close", w).alias("stock_index"),
        base100("sp500_value", w).alias("sp500_index"),
        cumulative_return("daily_return", w).alias("cum_return"),
        cumulative_return("sp500_return", w).alias("sp500_cum_return"),
    )


def performance_stats(fact: DataFrame, n: int = 30, symbol=None) -> DataFrame:
    """B2: mean return, mean alpha and sample deviation over the same latest ``n`` rows."""
    stats = agg.performance_stats(latest_rows(fact, n, symbol))
    return stats.select("symbol", _r("avg_daily_return"), _r("avg_alpha"), _r("volatility"),
                        "n_rows")


def performance_labels(stats: DataFrame) -> DataFrame:
    """Display strings of B2 (``f"{x*100:.2f}%"``)."""
    return stats.select("symbol", pct_fixed("avg_daily_return").alias("avg_daily_return"),
                        pct_fixed("avg_alpha").alias("avg_alpha"),
                        pct_fixed("volatility").alias("volatility"))


def vix_overlay(fact: DataFrame, n: int = 30, symbol=None) -> DataFrame:
    """Date and VIX level over each symbol's latest ``n`` rows."""
    return latest_rows(fact.select("symbol", "date", "vix_value"), n, symbol)


def stock_choices(dim: DataFrame) -> DataFrame:
    """A6 + F12: distinct (symbol, company_name) with the selector label."""
    return agg.stock_choices(dim).select(
        "symbol", "company_name", stock_label("symbol", "company_name").alias("label"))


def _r(c, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, STAT_DIGITS).alias(name or c)
