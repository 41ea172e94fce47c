"""Marts M4 (dim_stocks) and M5 (fact_daily_metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.expressions import alpha, cap_category
from marketlake.operators.aggregates import pivot_benchmarks
from marketlake.operators.joins import join_benchmarks, join_company

DIM_COLUMNS = ["symbol", "company_name", "sector", "industry", "market_cap", "pe_ratio",
               "dividend_yield", "beta", "country", "employees"]

FACT_COLUMNS = [
    "symbol", "date", "sector", "industry", "market_cap", "close", "adj_close", "volume",
    "daily_return", "daily_volatility", "price_change", "sp500_value", "sp500_return",
    "vix_value", "treasury_10y", "tech_sector_etf", "financial_sector_etf",
    "alpha_vs_sp500", "market_cap_category",
]


def dim_stocks(stg_company: DataFrame) -> DataFrame:
    """M4: eleven dimension columns; ``ingested_at`` becomes ``last_updated``."""
    return stg_company.select(*DIM_COLUMNS, F.col("ingested_at").alias("last_updated"))


def price_facts(stg_prices: DataFrame, pivot: DataFrame) -> DataFrame:
    """The part of the fact that needs no company: prices, their metrics, the benchmarks of
    the date and the excess return."""
    prices = stg_prices.select("symbol", "date", "close", "adj_close", "volume", "daily_return",
                               "daily_volatility", "price_change")
    return join_benchmarks(prices, pivot).withColumn(
        "alpha_vs_sp500", alpha("daily_return", "sp500_return"))


def with_company(facts: DataFrame, company: DataFrame) -> DataFrame:
    """M5: :func:`price_facts` with the company attributes and the cap band of the symbol."""
    sectors = company.select("symbol", "sector", "industry", "market_cap")
    return join_company(facts, sectors).withColumn(
        "market_cap_category", cap_category("market_cap")).select(*FACT_COLUMNS)


def fact_daily_metrics(stg_prices: DataFrame, stg_company: DataFrame,
                       stg_bench: DataFrame) -> DataFrame:
    """M5: one row per symbol and date with company attributes, the benchmark pivot, the
    excess return and the cap band.

    Columns not used downstream (open, high, low, volume_ma5) are pruned before the joins.
    """
    return with_company(price_facts(stg_prices, pivot_benchmarks(stg_bench)), stg_company)
