"""The daily model build: raw tables -> staging views -> materialised marts -> checks.

The reference's "run the SQL models, then run their tests" step, as one Spark application:

1. staging models are lazy views over the raw parquet tables;
2. the stock dimension is written first, so the company model is computed once, and the
   fact joins the written dimension;
3. the benchmark pivot is written next, so the fact's date join sees its real size;
4. the fact is written, partitioned by month and sorted by symbol within files, so a trend or a
   top-N reads the months it shows and skips row groups of other symbols;
5. the checks of the raw tables and staging views are Observations on those writes; the
   uniqueness checks read the written tables;
6. everything is written to a new build folder, and only a build whose checks pass is
   published: one entry of a small log switches all tables at once (``sinks.published``).
   ``plans.refresh`` brings published tables up to date without a full build.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.aggregates import pivot_benchmarks
from marketlake.operators import quality as q
from marketlake.operators.quality import DataQualityError
from marketlake.plans import checks, marts, staging
from marketlake.sinks import published
from marketlake.sinks.raw_store import materialise


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


FACT = "fact_daily_metrics"
#: rows of each symbol and month of the fact
COUNTS = "symbol_months"
#: the newest date and ingest time that a build has seen
MARKS = "build_marks"


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("date", "yyyy-MM"))


def write_fact(fact: DataFrame, path: str) -> None:
    """The fact by month, in files of the advisory size, sorted by symbol and date."""
    (with_month(fact).hint("rebalance", "month")
     .sortWithinPartitions("month", "symbol", "date")
     .write.mode("overwrite").partitionBy("month").parquet(path))


def write_counts(fact_path: str, path: str, spark: SparkSession) -> list[str]:
    """The rows of each symbol and month of a written fact, by month; returns the months' folders."""
    (spark.read.parquet(fact_path).groupBy("month", "symbol").agg(F.count("*").alias("rows"))
     .hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path))
    return published.parts_of(spark, path, "month")


def read_mart(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A table of the published build."""
    return published.read_published(spark, out_root.rstrip("/"), name)


def read_fact(spark: SparkSession, path: str, since=None, months: list[str] | None = None) -> DataFrame:
    """The fact at ``path``: a written table, or ``<marts>/fact_daily_metrics`` for the published one.

    With ``since`` (a date) only the months that can hold later rows are read, with ``months`` only those.
    """
    root, name = path.rstrip("/").rsplit("/", 1)
    live = published.files_of(spark, root, name)
    fact = published.read_published(spark, root, name) if live else spark.read.parquet(path)
    if since is not None:
        fact = fact.filter((F.col("month") >= str(since)[:7]) & (F.col("date") >= F.lit(since)))
    if months is not None:
        fact = fact.filter(F.col("month").isin(months))
    return fact.select(*marts.FACT_COLUMNS)


def staged(spark: SparkSession, raw_root: str, observed=lambda df, model: df
           ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The staging models (prices, benchmarks, companies) over the raw tables."""
    raw = {t: observed(spark.read.parquet(_path(raw_root, t)), t)
           for t in ("stock_prices_daily", "benchmark_series_daily", "company_info")}
    return (staging.stg_stock_prices(raw["stock_prices_daily"]),
            staging.stg_benchmark_series(raw["benchmark_series_daily"]),
            staging.stg_company_info(raw["company_info"]))


def build_marts(spark: SparkSession, raw_root: str, out_root: str, as_of,
                fail_on_error: bool = True) -> dict:
    """Rebuild staging views and marts from the raw tables under ``raw_root``.

    The checks of the raw tables and staging views are observed on the mart writes (row
    counts, NULL counts and the newest date are aggregated while the rows stream into the
    pivot, fact and dimension files), so they cost no extra pass over the raw data. Only
    the uniqueness checks read again, and they read the small written tables.

    With failed checks the published tables stay as they are and the new ones are left in the
    build folder, unpublished, for a look (``sinks.published.sweep`` removes such folders).

    Returns ``{"fact_rows", "dim_rows", "pivot_rows", "checks"}``.
    """
    out_root = out_root.rstrip("/")
    build_root = _path(out_root, f"build-{uuid.uuid4().hex}")
    nn = dict(checks.NOT_NULL)
    fresh = dict(checks.FRESHNESS)
    obs: dict[str, Observation] = {}

    def observed(df: DataFrame, model: str) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.sum(F.col(c).isNull().cast("long")).alias(f"nn_{c}") for c in nn.get(model, ())]
        if model in fresh:
            metrics += [F.max(fresh[model]).alias("max_date"),
                        F.max("ingested_at").cast("string").alias("ingest_mark")]
        obs[model] = Observation(model)
        return df.observe(obs[model], *metrics)

    stg_prices, stg_bench, stg_company = staged(spark, raw_root, observed)
    for name, df in (("stg_stock_prices", stg_prices), ("stg_company_info", stg_company),
                     ("stg_benchmark_series", stg_bench)):
        materialise(df, name)  # staging models stay views

    # 1. the dimension first: the company model is computed once, here
    dim_df = marts.dim_stocks(observed(stg_company, "stg_company_info"))
    dim = materialise(observed(dim_df, "dim_stocks"), "dim_stocks", "table",
                      _path(build_root, "dim_stocks"))
    # 2. the benchmark pivot, with its measured size
    pivot_path = _path(build_root, "benchmarks_pivot")
    pivot_benchmarks(observed(stg_bench, "stg_benchmark_series")) \
        .write.mode("overwrite").parquet(pivot_path)
    pivot = spark.read.parquet(pivot_path)
    pivot_rows = pivot.count()  # a few thousand rows at most; the footers answer it
    # 3. the fact, joined to the written dimension (a projection of the company model)
    fact_df = marts.with_company(
        marts.price_facts(observed(stg_prices, "stg_stock_prices"), pivot), dim)
    write_fact(observed(fact_df, "fact_daily_metrics"), _path(build_root, "fact_daily_metrics"))
    fact = read_fact(spark, _path(build_root, "fact_daily_metrics"))

    rows = _observed_rows(obs, as_of)
    # uniqueness: grouped passes over the written tables (the dimension is the company
    # model projected one to one, so it answers the staging check too)
    keyed = [q.check_model(dim, "stg_company_info", unique="symbol"),
             q.check_model(dim, "dim_stocks", unique="symbol"),
             q.check_model(fact, "fact_daily_metrics",
                           unique_combination=dict(checks.UNIQUE_COMBINATION)["fact_daily_metrics"])]
    rows += [r.asDict() for part in keyed for r in part.collect()]  # one row per check
    results = spark.createDataFrame(rows, q.RESULT_SCHEMA)
    results.write.mode("overwrite").parquet(_path(build_root, "data_quality"))
    failed = [r for r in rows if r["status"] == "fail"]
    if failed and fail_on_error:
        raise DataQualityError(f"{len(failed)} data-quality checks failed: {failed}")
    seen = obs["stock_prices_daily"].get
    newest = seen["max_date"] and str(seen["max_date"])
    spark.createDataFrame([(newest, seen["ingest_mark"])], "date_mark string, ingest_mark string") \
        .write.mode("overwrite").parquet(_path(build_root, MARKS))
    parts = write_counts(_path(build_root, FACT), _path(build_root, COUNTS), spark) or [""]
    names = ["dim_stocks", "benchmarks_pivot", FACT, COUNTS, "data_quality", MARKS]
    published.publish(spark, out_root, {n: _path(build_root, n) for n in names},
                      {FACT: parts, COUNTS: parts}, withdraw=["fact_by_symbol"])
    read_fact(spark, _path(out_root, "fact_daily_metrics")).createOrReplaceTempView(
        "fact_daily_metrics")
    read_mart(spark, out_root, "dim_stocks").createOrReplaceTempView("dim_stocks")
    return {"fact_rows": int(obs["fact_daily_metrics"].get["rows"]),
            "dim_rows": int(obs["dim_stocks"].get["rows"]), "pivot_rows": pivot_rows, "checks": rows}


def _observed_rows(obs: dict, as_of) -> list[dict]:
    """Check rows of the not-null, non-empty and freshness checks from the observed metrics."""
    import datetime as dt
    nn = dict(checks.NOT_NULL)
    fresh = dict(checks.FRESHNESS)
    out = []
    for model, o in obs.items():
        m = o.get
        for c in nn.get(model, ()):
            n = int(m.get(f"nn_{c}") or 0)
            out.append(_row("not_null", model, c, n, "fail" if n > 0 else "pass"))
        if model in checks.NON_EMPTY:
            n = int(m["rows"])
            out.append(_row("non_empty", model, "*", n, "fail" if n == 0 else "pass"))
        if model in fresh:
            newest = m.get("max_date")
            as_of_d = dt.date.fromisoformat(str(as_of))
            age = (as_of_d - newest).days if newest is not None else None
            status = ("fail" if age is None else "warn" if age > q.FRESHNESS_DAYS else "pass")
            out.append(_row("freshness", model, fresh[model], age, status))
    return out


def _row(check, obj, column, observed, status) -> dict:
    return {"check_name": check, "object_name": obj, "column_name": column,
            "observed": observed, "status": status}
