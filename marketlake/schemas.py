"""Table schemas of the raw, metadata and model layers (fixed values: the reference's DDL).

Raw tables are append-only parquet datasets; NOT NULL and primary keys are declared in
the reference DDL but are not enforced by parquet, so ``operators.quality`` checks them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, L, I, TS = (T.StringType(), T.DoubleType(), T.DateType(), T.LongType(),
                      T.IntegerType(), T.TimestampNTZType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


STOCK_PRICES_DAILY = T.StructType([
    _f("symbol", S, False), _f("date", DT, False), _f("open", D), _f("high", D), _f("low", D),
    _f("close", D, False), _f("adj_close", D), _f("volume", L), _f("ingested_at", TS),
    _f("source_run_id", S),
])

COMPANY_INFO = T.StructType([
    _f("symbol", S, False), _f("company_name", S), _f("sector", S), _f("industry", S),
    _f("market_cap", L), _f("enterprise_value", L), _f("pe_ratio", D), _f("forward_pe", D),
    _f("peg_ratio", D), _f("price_to_book", D), _f("dividend_yield", D), _f("beta", D),
    _f("fifty_two_week_high", D), _f("fifty_two_week_low", D), _f("fifty_day_average", D),
    _f("two_hundred_day_average", D), _f("shares_outstanding", L), _f("float_shares", L),
    _f("employees", I), _f("country", S), _f("city", S), _f("website", S),
    _f("business_summary", S), _f("ingested_at", TS), _f("source_run_id", S), _f("error", S),
])

BENCHMARK_SERIES_DAILY = T.StructType([
    _f("series_ticker", S, False), _f("date", DT, False), _f("value", D, False),
    _f("ingested_at", TS), _f("source_run_id", S),
])

INGEST_RUNS = T.StructType([
    _f("run_id", S, False), _f("dataset_name", S, False), _f("table_name", S, False),
    _f("run_timestamp", TS), _f("records_loaded", L), _f("status", S), _f("error_message", S),
])

WATERMARKS = T.StructType([
    _f("dataset_name", S, False), _f("watermark_value", S), _f("updated_at", TS),
])

# Raw tables by name; ``sinks.raw_store.create_table`` materialises them empty.
RAW_TABLES = {
    "stock_prices_daily": STOCK_PRICES_DAILY,
    "company_info": COMPANY_INFO,
    "benchmark_series_daily": BENCHMARK_SERIES_DAILY,
    "ingest_runs": INGEST_RUNS,
    "watermarks": WATERMARKS,
}

# The fields a company document contributes, in table order
# (document key -> column, type).
COMPANY_DOC_FIELDS = [
    ("sector", "sector", S), ("industry", "industry", S), ("marketCap", "market_cap", L),
    ("enterpriseValue", "enterprise_value", L), ("trailingPE", "pe_ratio", D),
    ("forwardPE", "forward_pe", D), ("pegRatio", "peg_ratio", D),
    ("priceToBook", "price_to_book", D), ("dividendYield", "dividend_yield", D),
    ("beta", "beta", D), ("fiftyTwoWeekHigh", "fifty_two_week_high", D),
    ("fiftyTwoWeekLow", "fifty_two_week_low", D), ("fiftyDayAverage", "fifty_day_average", D),
    ("twoHundredDayAverage", "two_hundred_day_average", D),
    ("sharesOutstanding", "shares_outstanding", L), ("floatShares", "float_shares", L),
    ("fullTimeEmployees", "employees", I), ("country", "country", S), ("city", "city", S),
    ("website", "website", S), ("longBusinessSummary", "business_summary", S),
]
