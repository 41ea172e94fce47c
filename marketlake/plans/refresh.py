"""Incremental refresh of the fact: only what a batch of new raw rows changes is derived again.

What a batch changes (its closure):

* the (symbol, date) keys of its price rows, corrections of old days included;
* the row after each of them in its symbol, whose return looks back at a new price;
* all symbols of a date whose benchmark row differs from the last build's (a late benchmark value
  changes its own date and the return of the series' next one);
* all dates of a symbol whose company attributes differ from the last build's.

Prices are read for the batch's keys alone (a semi join, so day folders without them are pruned);
neighbours and unchanged columns come from the written fact, which holds every staged price.
The pivot and the dimension are derived whole: they have a row per date and per symbol. The
result is that of a full rebuild, row by row, because each changed row is composed by the
functions of the full build from the same inputs. Keys are not null (the raw tables' contract).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import quality as q
from marketlake.operators.aggregates import pivot_benchmarks
from marketlake.operators.dedup import latest_version
from marketlake.operators.filters import arrived_since
from marketlake.operators.quality import DataQualityError
from marketlake.operators.windows import (entity_window, pct_change, prev, price_change,
                                          range_volatility)
from marketlake.plans import checks, marts, staging
from marketlake.plans.build import (COUNTS, FACT, MARKS, read_fact, read_mart, staged, with_month,
                                    write_counts, write_fact)
from marketlake.sinks import published

KEYS = ["symbol", "date"]
PRICE_PART = ["symbol", "date", "close", "adj_close", "volume", "daily_return", "daily_volatility",
              "price_change"]
COMPANY_PART = ["symbol", "sector", "industry", "market_cap"]


def new_versions(raw: DataFrame, arrived: DataFrame, tie_breakers=("source_run_id",)) -> DataFrame:
    """The latest version of every key that has an arrived row."""
    keys = arrived.select(*KEYS).distinct()
    return latest_version(raw.join(keys, KEYS, "left_semi"), KEYS, "ingested_at", tie_breakers)


def changed_prices(old: DataFrame, latest: DataFrame) -> DataFrame:
    """The fact's price part of the ``latest`` versions and of the row after each of them."""
    new = latest.select(
        *PRICE_PART[:5], F.lit(None).cast("double").alias("daily_return"),
        range_volatility("high", "low", "close").alias("daily_volatility"),
        price_change("close", "open").alias("price_change"), F.lit(True).alias("is_new"))
    series = (old.select(*PRICE_PART, F.lit(False).alias("is_new"))
              .join(latest.select("symbol").distinct(), "symbol", "left_semi")
              .join(latest.select(*KEYS), KEYS, "left_anti"))
    w = entity_window(["symbol"])
    return series.unionByName(new).select(
        *PRICE_PART[:5], pct_change("close", w).alias("daily_return"), "daily_volatility",
        "price_change", (F.col("is_new") | F.coalesce(prev("is_new", w), F.lit(False))).alias("changed"),
    ).filter("changed").drop("changed")


def differing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ, that are new, or that are gone."""
    return (new.exceptAll(old).select(key).unionByName(old.exceptAll(new).select(key))).distinct()


def changed_rows(old: DataFrame, latest: DataFrame, old_pivot: DataFrame, pivot: DataFrame,
                 old_company: DataFrame, company: DataFrame) -> DataFrame:
    """All fact rows that differ from ``old``, and perhaps some that don't."""
    prices = changed_prices(old, latest)
    dates = differing(old_pivot, pivot, "date").withColumn("by_date", F.lit(True))
    symbols = differing(old_company.select(*COMPANY_PART), company.select(*COMPANY_PART), "symbol") \
        .withColumn("by_symbol", F.lit(True))
    others = (old.select(*PRICE_PART).join(dates, "date", "left").join(symbols, "symbol", "left")
              .filter("by_date OR by_symbol").select(*PRICE_PART)
              .join(prices.select(*KEYS), KEYS, "left_anti"))
    return marts.with_company(marts.price_facts(prices.unionByName(others), pivot), company)


def refreshed(old: DataFrame, rows: DataFrame) -> DataFrame:
    """``old`` with ``rows`` in the place of rows with the same key."""
    return old.join(rows.select(*KEYS), KEYS, "left_anti").unionByName(rows)


def refresh_marts(spark: SparkSession, raw_root: str, out_root: str, overlap_days: int = 1,
                  fail_on_error: bool = True) -> dict:
    """Bring the published marts up to the raw tables, writing only the months that change.

    The new months, the dimension and the pivot are written to a folder of their own and published
    together after their checks; a refresh that breaks or fails its checks leaves the tables as they are, and
    the next one does its work, since the ingest mark is published with the tables.

    Returns ``{"changed_rows", "months", "checks"}``.
    """
    raw_root, out_root = raw_root.rstrip("/"), out_root.rstrip("/")
    build_root = f"{out_root}/build-{uuid.uuid4().hex}"
    old = read_fact(spark, f"{out_root}/{FACT}")
    mark = read_mart(spark, out_root, MARKS).first()
    raw = spark.read.parquet(f"{raw_root}/stock_prices_daily")
    _, bench, company = staged(spark, raw_root)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{build_root}/{name}")
        return spark.read.parquet(f"{build_root}/{name}")

    dim = written(marts.dim_stocks(company), "dim_stocks")
    pivot = written(pivot_benchmarks(bench), "benchmarks_pivot")
    arrived = arrived_since(raw, mark["ingest_mark"], overlap_days)
    latest = written(new_versions(raw, arrived), "_latest")
    rows = written(changed_rows(old, latest, read_mart(spark, out_root, "benchmarks_pivot"), pivot,
                                read_mart(spark, out_root, "dim_stocks"), dim), "_changed")
    months = [r.month for r in with_month(rows).select("month").distinct().collect()]
    n_rows = rows.count()
    model, parts = FACT, []
    results = [q.check_model(dim, "dim_stocks", not_null=dict(checks.NOT_NULL)["dim_stocks"],
                             unique="symbol")]
    if months:
        same_months = read_fact(spark, f"{out_root}/{model}", months=months)
        write_fact(refreshed(same_months, rows), f"{build_root}/{model}")
        parts = write_counts(f"{build_root}/{model}", f"{build_root}/{COUNTS}", spark)
        results.append(q.check_model(
            spark.read.parquet(f"{build_root}/{model}"), model, not_null=dict(checks.NOT_NULL)[model],
            unique_combination=dict(checks.UNIQUE_COMBINATION)[model]))
    # the marks come from what arrived; rows that land meanwhile are the next refresh's
    newest = arrived.agg(F.max("date").cast("string").alias("date_mark"),
                         F.max("ingested_at").cast("string").alias("ingest_mark"))
    written(newest.select(*[F.coalesce(F.greatest(F.col(c), F.lit(mark[c])), F.lit(mark[c])).alias(c)
                            for c in newest.columns]), MARKS)
    found = [r.asDict() for part in results for r in part.collect()]  # one row per check
    written(spark.createDataFrame(found, q.RESULT_SCHEMA), "refresh_quality")
    failed = [r for r in found if r["status"] == "fail"]
    if failed and fail_on_error:
        raise DataQualityError(f"{len(failed)} data-quality checks failed: {failed}")
    tables = ["dim_stocks", "benchmarks_pivot", MARKS, "refresh_quality", *([model, COUNTS] if parts else [])]
    published.publish(spark, out_root, {t: f"{build_root}/{t}" for t in tables},
                      {model: parts, COUNTS: parts}, whole=False,
                      withdraw=["fact_by_symbol"] if parts else [])
    return {"changed_rows": n_rows, "months": sorted(months), "checks": found}
