"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Benchmark series and the fact columns they feed (series, measure, column).
BENCHMARK_COLUMNS = [
    ("^GSPC", "value", "sp500_value"),
    ("^GSPC", "pct_change", "sp500_return"),
    ("^VIX", "value", "vix_value"),
    ("^TNX", "value", "treasury_10y"),
    ("XLK", "value", "tech_sector_etf"),
    ("XLF", "value", "financial_sector_etf"),
]


def pivot_benchmarks(stg_bench: DataFrame, columns=BENCHMARK_COLUMNS,
                     ticker_col: str = "series_ticker") -> DataFrame:
    """One row per date with one column per (series, measure) (A1).

    ``MAX(CASE WHEN series = s THEN measure END)``: explicit values, so no extra job to
    discover them, and a hash aggregate with map-side partial combine.
    """
    aggs = [F.max(F.when(F.col(ticker_col) == F.lit(s), F.col(m))).alias(name)
            for s, m, name in columns]
    return stg_bench.groupBy("date").agg(*aggs)


def fact_by_symbol(fact: DataFrame) -> DataFrame:
    """Per-symbol screener aggregates over the fact table (the pre-aggregation side of A2).

    The fact is already hash-partitioned by symbol, so this aggregate adds no shuffle.
    ``MAX(market_cap_category)`` is lexicographic; the category is constant per symbol.
    """
    return fact.groupBy("symbol").agg(
        F.max("market_cap_category").alias("market_cap_category"),
        F.max("date").alias("latest_date"),
        F.avg("close").alias("avg_close"),
        F.avg("daily_return").alias("avg_return"),
        F.avg("alpha_vs_sp500").alias("avg_alpha"),
    )


def performance_stats(rows: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Mean and sample standard deviation (ddof=1) of returns, mean alpha.

    NULLs are skipped; a single row gives a NULL deviation (pandas: NaN).
    """
    return rows.groupBy(*keys).agg(
        F.avg("daily_return").alias("avg_daily_return"),
        F.avg("alpha_vs_sp500").alias("avg_alpha"),
        F.stddev_samp("daily_return").alias("volatility"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def latest_date(df: DataFrame, col: str = "date") -> DataFrame:
    """``MAX(date)``; a global aggregate always returns one row, NULL when empty (A4)."""
    return df.agg(F.max(col).alias("latest_date"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``SELECT 'name', COUNT(*) ... UNION ALL ...``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values."""
    return df.select(col).dropna().distinct().orderBy(col)


def stock_choices(dim: DataFrame) -> DataFrame:
    """``SELECT DISTINCT symbol, company_name``."""
    return dim.select("symbol", "company_name").distinct()


def batch_profile(df: DataFrame, date_col: str = "date", key_col: str = "symbol") -> DataFrame:
    """Load profile of a batch: rows, first and last date, number of distinct keys."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
        F.count_distinct(key_col).alias("n_keys"),
    )
