"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through ``sources.fixtures``) in full and returns a
lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.expressions import age_days, days_before, parse_date, round_even
from marketlake.operators.aggregates import (batch_profile, distinct_values, pivot_benchmarks,
                                             row_counts)
from marketlake.operators.dedup import latest_version
from marketlake.operators.filters import (arrived_since, incremental, late_rows, restrict,
                                          select_range)
from marketlake.operators import quality as q
from marketlake.operators.quality import orphan_rows
from marketlake.operators.topk import top_n
from marketlake.operators.windows import entity_window, moving_avg, segmented
from marketlake.plans import dashboard as dash
from marketlake.plans import marts, refresh, staging
from marketlake.plans.checks import run_suite
from marketlake.sinks import raw_store
from marketlake.sources import documents as docs
from marketlake.sources import fixtures as fx
from marketlake.sources import reshape
from marketlake.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# --- model builders over the fixture tables -------------------------------------------
def raw_prices(spark, d):
    return fx.raw_prices(spark, d)


def raw_company(spark, d):
    return fx.raw_company(spark, d)


def raw_bench(spark, d):
    return fx.raw_benchmarks(spark, d)


def stg_prices(spark, d):
    return staging.stg_stock_prices(raw_prices(spark, d))


def stg_company(spark, d):
    return staging.stg_company_info(raw_company(spark, d))


def stg_bench(spark, d):
    return staging.stg_benchmark_series(raw_bench(spark, d))


def fact(spark, d):
    return marts.fact_daily_metrics(stg_prices(spark, d), stg_company(spark, d),
                                    stg_bench(spark, d))


def price_facts(spark, d):
    return marts.price_facts(stg_prices(spark, d), pivot_benchmarks(stg_bench(spark, d)))


def dim(spark, d):
    return marts.dim_stocks(stg_company(spark, d))


# --- M1-M5, A1 ----------------------------------------------------------------------------
@query("fact_daily_metrics")
def q_fact(spark, d):
    return fact(spark, d)


@query("stg_stock_prices")
def q_stg_prices(spark, d):
    return stg_prices(spark, d)


@query("stg_company_info")
def q_stg_company(spark, d):
    return stg_company(spark, d)


@query("stg_benchmark_series")
def q_stg_bench(spark, d):
    return stg_bench(spark, d)


@query("benchmark_pivot")
def q_bench_pivot(spark, d):
    return pivot_benchmarks(stg_bench(spark, d))


@query("dim_stocks")
def q_dim(spark, d):
    return dim(spark, d)


# --- dashboard: B0-B5, A2, A6, A7, A10 ------------------------------------------------------

# Screener parameters of the filtered registration (a sector and a cap band).
SCREEN_SECTOR, SCREEN_CAP = "AUTOMOBILE", "Large Cap"
DISPLAY_ROWS = 30


@query("home_kpis")
def q_home_kpis(spark, d):
    return dash.home_kpis(dim(spark, d), price_facts(spark, d))


@query("stock_summary")
def q_stock_summary(spark, d):
    return dash.stock_summary(dim(spark, d), fact(spark, d))


@query("screener_filtered")
def q_screener_filtered(spark, d):
    return dash.screener(dim(spark, d), fact(spark, d), SCREEN_SECTOR, SCREEN_CAP)


@query("screener_count")
def q_screener_count(spark, d):
    return dash.screener_count(dash.screener(dim(spark, d), fact(spark, d), SCREEN_SECTOR,
                                             SCREEN_CAP))


@query("price_trend")
def q_price_trend(spark, d):
    # the latest loaded date: the fact holds one row per deduplicated price, so its newest
    # date is the raw table's, read from one column instead of re-running the dedup
    as_of = raw_prices(spark, d).select(F.max("date")).scalar()
    return dash.price_trend(price_facts(spark, d),
                            dash.screened_symbols(dim(spark, d), SCREEN_SECTOR, SCREEN_CAP), as_of)


@query("benchmark_comparison")
def q_benchmark_comparison(spark, d):
    return dash.benchmark_comparison(price_facts(spark, d), DISPLAY_ROWS)


@query("performance_stats")
def q_performance_stats(spark, d):
    return dash.performance_stats(price_facts(spark, d), DISPLAY_ROWS)


@query("vix_overlay")
def q_vix_overlay(spark, d):
    return dash.vix_overlay(price_facts(spark, d), DISPLAY_ROWS)


@query("stock_choices")
def q_stock_choices(spark, d):
    return dash.stock_choices(dim(spark, d))


@query("sector_choices")
def q_sector_choices(spark, d):
    return distinct_values(dash.stock_summary(dim(spark, d), fact(spark, d)), "sector")


@query("symbol_choices")
def q_symbol_choices(spark, d):
    return distinct_values(dash.stock_summary(dim(spark, d), fact(spark, d)), "symbol")


# --- data quality: Q1-Q5 ---------------------------------------------------------------------

# Evaluation date of the freshness check (a parameter, never the clock).
DQ_AS_OF = "2024-02-08"


def models(spark, d):
    return {
        "stock_prices_daily": raw_prices(spark, d),
        "company_info": raw_company(spark, d),
        "benchmark_series_daily": raw_bench(spark, d),
        "stg_stock_prices": stg_prices(spark, d),
        "stg_company_info": stg_company(spark, d),
        "stg_benchmark_series": stg_bench(spark, d),
        "dim_stocks": dim(spark, d),
        "fact_daily_metrics": fact(spark, d),
    }


@query("data_quality")
def q_data_quality(spark, d):
    return run_suite(models(spark, d), DQ_AS_OF)


@query("fact_orphans")
def q_fact_orphans(spark, d):
    return orphan_rows(price_facts(spark, d), dim(spark, d))


# --- sources: S1-S16 ---------------------------------------------------------------------------


@query("prices_long")
def q_prices_long(spark, d):
    return reshape.prices_long(fx.wide_daily_bars(spark, d), fx.WIDE_REQUEST)


@query("benchmark_long")
def q_benchmark_long(spark, d):
    return reshape.benchmark_long(fx.wide_daily_bars(spark, d), fx.WIDE_REQUEST)


@query("company_from_json")
def q_company_from_json(spark, d):
    return docs.company_from_json(fx.company_documents(spark, d))


@query("crew_messages")
def q_crew_messages(spark, d):
    return docs.explode_messages(fx.event_crew_lists(spark, d), "crew", keep=("event_id",))


@query("prices_period_5d")
def q_prices_period(spark, d):
    raw = raw_prices(spark, d)
    as_of = raw.select(F.max("date")).scalar()
    return select_range(raw, period="5d", as_of=as_of)


@query("universe_prices")
def q_universe_prices(spark, d):
    """Prices restricted to a universe given as a DataFrame of symbols (semi join)."""
    universe = read_table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("symbol"))
    return restrict(raw_prices(spark, d), "symbol", universe)


# --- loads: K9-K12, A9, A5/U2, L5 ----------------------------------------------------------


@query("watermark_upsert")
def q_watermark_upsert(spark, d):
    current, updates = fx.watermark_states(spark, d)
    return raw_store.upsert_watermark(current, updates)


@query("incremental_prices")
def q_incremental_prices(spark, d):
    """The second run's batch: raw prices above the stock_prices watermark of the first."""
    current, _ = fx.watermark_states(spark, d)
    return incremental(raw_prices(spark, d), raw_store.watermark_column(current, "stock_prices"))


@query("incremental_profile")
def q_incremental_profile(spark, d):
    return batch_profile(q_incremental_prices(spark, d), "date", "symbol")


@query("late_corrections")
def q_late_corrections(spark, d):
    """Rows of the second load for dates below the first load's mark, with the close they replace."""
    raw = fx.corrected_prices(spark, d)
    first = fx.first_load(raw)
    late = late_rows(raw, first.select(F.max("date")).scalar(),
                     first.select(F.max("ingested_at")).scalar())
    before = latest_version(first, refresh.KEYS, "ingested_at", ["source_run_id"]).select(
        *refresh.KEYS, F.col("close").alias("replaced_close"))
    return late.select("symbol", "date", "close", "ingested_at", "source_run_id").join(
        before, refresh.KEYS, "left")


@query("fact_refreshed")
def q_fact_refreshed(spark, d):
    """The fact of the first load, refreshed with the second: what a rebuild of both gives."""
    raw, bench = fx.corrected_prices(spark, d), fx.corrected_benchmarks(spark, d)
    old_company = staging.stg_company_info(fx.first_company(spark, d))
    old_pivot = raw_store.written_once(
        pivot_benchmarks(staging.stg_benchmark_series(fx.first_load(bench))), "old_pivot")
    # as in the refresh job, what the last build wrote is read, not derived again
    old = raw_store.written_once(marts.with_company(
        marts.price_facts(staging.stg_stock_prices(fx.first_load(raw)), old_pivot), old_company), "old_fact")
    mark = fx.first_load(raw).select(F.max("ingested_at")).scalar()
    latest = raw_store.written_once(refresh.new_versions(raw, arrived_since(raw, mark)), "latest")
    rows = refresh.changed_rows(
        old, latest, old_pivot, pivot_benchmarks(staging.stg_benchmark_series(bench)),
        old_company, stg_company(spark, d))
    return refresh.refreshed(old, raw_store.written_once(rows, "changed"))


@query("row_counts")
def q_row_counts(spark, d):
    return row_counts({"stock_prices_daily": raw_prices(spark, d),
                       "company_info": raw_company(spark, d),
                       "benchmark_series_daily": raw_bench(spark, d)})


@query("latest_runs")
def q_latest_runs(spark, d):
    """The ten newest runs of the ingestion log."""
    return top_n(fx.ingest_runs(spark, d), 10, F.col("run_timestamp").desc(),
                 F.col("run_id").desc())


# --- long history: M1/M5 on deep series, W12 -------------------------------------------------


def long_prices(spark, d):
    return staging.stg_stock_prices(fx.raw_long_prices(spark, d), fx.LONG_HISTORY_TIE)


@query("fact_long_history")
def q_fact_long(spark, d):
    company = stg_company(spark, d).withColumn("symbol", F.col("symbol").cast("string"))
    return marts.fact_daily_metrics(long_prices(spark, d), company, stg_bench(spark, d))


@query("long_history_ma20")
def q_long_ma20(spark, d):
    p = long_prices(spark, d)
    w = entity_window(["symbol"])
    return p.select("symbol", "date", "close", "volume_ma5",
                    moving_avg("close", w, 20).alias("close_ma20"))


@query("long_history_by_year")
def q_long_by_year(spark, d):
    """The windows of a long history by symbol and year instead of by symbol."""
    staged = staging.stg_stock_prices(fx.raw_long_prices(spark, d), fx.LONG_HISTORY_TIE, by_year=True)
    w = entity_window(["symbol", "segment"])
    return segmented(staged, ["symbol"], 19).select(
        "symbol", "date", "close", "daily_return", "volume_ma5", "carried",
        moving_avg("close", w, 20).alias("close_ma20")).filter("NOT carried").drop("carried")


@query("benchmarks_by_year")
def q_benchmarks_by_year(spark, d):
    """Changes of every brand's long series, taken as benchmark series, by series and year."""
    raw = fx.raw_long_prices(spark, d).select(
        F.col("symbol").alias("series_ticker"), "date", F.col("close").alias("value"), "ingested_at",
        "source_run_id", *fx.LONG_HISTORY_TIE)
    return staging.stg_benchmark_series(raw, fx.LONG_HISTORY_TIE, by_year=True)


# --- inputs with gaps, part matches and windows that cut -------------------------------------


def shifted_facts(spark, d):
    """The price part of the fact over a long history whose last days have benchmarks."""
    prices = staging.stg_stock_prices(fx.shifted_long_prices(spark, d), fx.LONG_HISTORY_TIE)
    return marts.price_facts(prices, pivot_benchmarks(stg_bench(spark, d)))


@query("fact_mixed_match")
def q_fact_mixed(spark, d):
    """M5 where only some symbols have a company and only some dates a benchmark."""
    prices = staging.stg_stock_prices(fx.shifted_long_prices(spark, d, by_part=True),
                                      fx.LONG_HISTORY_TIE)
    return marts.fact_daily_metrics(prices, stg_company(spark, d), stg_bench(spark, d))


@query("comparison_long_history")
def q_comparison_long(spark, d):
    return dash.benchmark_comparison(shifted_facts(spark, d), DISPLAY_ROWS)


@query("stats_long_history")
def q_stats_long(spark, d):
    return dash.performance_stats(shifted_facts(spark, d), DISPLAY_ROWS)


@query("vix_long_history")
def q_vix_long(spark, d):
    return dash.vix_overlay(shifted_facts(spark, d), DISPLAY_ROWS)


@query("price_trend_long_history")
def q_trend_long(spark, d):
    """The trailing 30 days of a long history (of all its symbols, parts without a brand included)."""
    raw = fx.shifted_long_prices(spark, d)
    shown = read_table(spark, d, "part").select(F.col("p_brand").alias("symbol")).distinct()
    return dash.price_trend(shifted_facts(spark, d), shown, raw.select(F.max("date")).scalar(),
                            nulls=True)


@query("zero_price_returns")
def q_zero_prices(spark, d):
    staged = staging.stg_stock_prices(fx.prices_with_gaps(spark, d))
    return staged.select("symbol", "date", "close", "daily_return", "daily_volatility")


@query("prices_long_gaps")
def q_prices_long_gaps(spark, d):
    return reshape.prices_long(fx.wide_bars_with_gaps(spark, d), fx.WIDE_REQUEST)


@query("benchmark_long_gaps")
def q_benchmark_long_gaps(spark, d):
    return reshape.benchmark_long(fx.wide_bars_with_gaps(spark, d), fx.WIDE_REQUEST)


@query("raw_table_checks")
def q_raw_table_checks(spark, d):
    """The single checks over raw tables that have gaps, versions and unknown symbols."""
    prices, company = fx.prices_with_gaps(spark, d), raw_company(spark, d)
    return q.union_checks([
        q.check_not_null(prices, ["symbol", "close"], "prices"),
        q.check_unique(company, "symbol", "company"),
        q.check_unique_combination(prices, ["symbol", "date"], "prices"),
        q.check_non_empty(prices, "prices"),
        q.check_freshness(prices, "prices", DQ_AS_OF),
        q.orphan_rows(fx.shifted_long_prices(spark, d, by_part=True), company, obj="long"),
    ])


# --- forms of a download, documents and display ----------------------------------------------


@query("prices_single")
def q_prices_single(spark, d):
    return reshape.prices_single(fx.flat_download(spark, d, "view"), "^GSPC")


@query("benchmark_single")
def q_benchmark_single(spark, d):
    return reshape.benchmark_single(fx.flat_download(spark, d, "error"), "^VIX")


@query("prices_range")
def q_prices_range(spark, d):
    return select_range(raw_prices(spark, d), start="2024-01-05", end="2024-01-20")


@query("coerced_dates")
def q_coerced_dates(spark, d):
    ev = read_table(spark, d, "events")
    return raw_store.coerce_dates(ev.select("event_id", F.col("ts").alias("trade_date"),
                                            F.col("ts").alias("seen_at")))


@query("bound_sql")
def q_bound_sql(spark, d):
    raw_prices(spark, d).createOrReplaceTempView("bound_sql_prices")
    return raw_store.run_sql(
        spark, "SELECT symbol, date, close FROM bound_sql_prices "
               "WHERE date >= CAST(:since AS DATE) AND close > :floor",
        since="2024-01-10", floor=50.0)


# The symbol of the one-symbol forms (a parameter).
SHOWN_SYMBOL = 7


@query("symbol_latest_prices")
def q_symbol_latest(spark, d):
    """The ten latest prices of one symbol."""
    rows = stg_prices(spark, d).where(F.col("symbol") == SHOWN_SYMBOL)
    return top_n(rows, 10, F.col("date").desc()).select("symbol", "date", "close", "volume")


@query("comparison_display")
def q_comparison_display(spark, d):
    """The comparison of every symbol with cumulative returns in percent."""
    rows = dash.benchmark_comparison(price_facts(spark, d), DISPLAY_ROWS)
    return rows.select("symbol", "date", "stock_index", "sp500_index",
                       (F.col("cum_return") * 100.0).alias("cum_return_pct"),
                       (F.col("sp500_cum_return") * 100.0).alias("sp500_cum_return_pct"))


@query("home_kpi_labels")
def q_home_kpi_labels(spark, d):
    return dash.home_kpi_labels(dash.home_kpis(dim(spark, d), price_facts(spark, d)))


@query("screener_display")
def q_screener_display(spark, d):
    return dash.screener_display(dash.screener(dim(spark, d), fact(spark, d)))


@query("performance_labels")
def q_performance_labels(spark, d):
    return dash.performance_labels(dash.performance_stats(price_facts(spark, d), DISPLAY_ROWS))


@query("company_numbers")
def q_company_numbers(spark, d):
    return docs.company_from_json(fx.number_documents(spark, d)).select(
        "symbol", "sector", "market_cap", "employees", "error")


@query("ragged_records")
def q_ragged_records(spark, d):
    raw = raw_company(spark, d)
    good = raw.where("error IS NULL").select("symbol", "company_name", "ingested_at")
    return docs.company_records(good, raw.where("error IS NOT NULL").select(
        "symbol", "ingested_at", "error"))


@query("date_parts")
def q_date_parts(spark, d):
    ev = read_table(spark, d, "events").withColumn("date", F.to_date("ts"))
    return ev.select("event_id", days_before(F.col("date"), 30).alias("before"),
                     parse_date(F.date_format("ts", "yyyy-MM-dd")).alias("parsed"),
                     age_days(DQ_AS_OF, "date").cast("bigint").alias("age"))


@query("rounded_prices")
def q_rounded_prices(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", round_even(F.col("value") / 8, 2).alias("rounded"),
                     round_even(F.col("event_id") / 8, 2).alias("ties"))
