"""The bucketed copy of the fact and the months of the latest rows."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketlake.plans import build, layout
from marketlake.plans import dashboard as dash
from marketlake.sinks import published
from marketlake.sources import fixtures as fx


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    """Published marts of a long history: ten years of 25 symbols, one of which ended early."""
    root = str(tmp_path_factory.mktemp("marts"))
    long = fx.raw_long_prices(spark, SF_SMALL).select(
        *[c for c in fx.raw_prices(spark, SF_SMALL).columns]).withColumn("ingested_at", F.col(
            "ingested_at").cast("timestamp_ntz"))
    end = F.when(F.col("symbol") == "Brand#11", F.lit("1995-06-01")).otherwise("9999-01-01")
    long.filter(F.col("date") < end.cast("date")).write.parquet(f"{root}/raw/stock_prices_daily")
    fx.raw_company(spark, SF_SMALL).withColumn("symbol", F.concat(F.lit("Brand#"), "symbol")) \
        .write.parquet(f"{root}/raw/company_info")
    fx.raw_benchmarks(spark, SF_SMALL).write.parquet(f"{root}/raw/benchmark_series_daily")
    build.build_marts(spark, f"{root}/raw", f"{root}/out", as_of="2024-02-08")
    return f"{root}/out"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_by_symbol_needs_no_exchange_of_the_fact(spark, out):
    assert layout.read_by_symbol(spark, out) is None
    assert layout.publish_by_symbol(spark, out, 4) == 4
    fact, dim = layout.read_by_symbol(spark, out), build.read_mart(spark, out, "dim_stocks")
    plain = build.read_fact(spark, f"{out}/fact_daily_metrics")
    assert sorted(fact.columns) == sorted(plain.columns)
    assert fact.exceptAll(plain.select(*fact.columns)).isEmpty() and fact.count() == plain.count()
    for query in (lambda f: dash.benchmark_comparison(f, 30), lambda f: dash.performance_stats(f, 30),
                  lambda f: dash.vix_overlay(f, 30), lambda f: f.groupBy("symbol").agg(F.max("close"))):
        plan = executed(query(fact))
        assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
        assert "Exchange hashpartitioning" in executed(query(plain))
        assert sorted(map(str, query(fact).collect())) == sorted(map(str, query(plain).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(dash.stock_summary(dim, fact))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the dimension is dealt to the fact's buckets; the fact stays where it is
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "SortMergeJoin" in plan


def test_a_build_withdraws_the_copy(spark, out, tmp_dir):
    layout.publish_by_symbol(spark, out)
    assert layout.read_by_symbol(spark, out) is not None
    published.publish(spark, out, {}, withdraw=[layout.BY_SYMBOL])
    assert layout.read_by_symbol(spark, out) is None
    assert layout.bucket_count(0) == 1 and layout.bucket_count(9_000_000) == 3


@pytest.mark.parametrize("n", [1, 5, 30])
def test_latest_rows_come_from_few_months(spark, out, n):
    whole = build.read_fact(spark, f"{out}/fact_daily_metrics")
    some = layout.read_latest(spark, out, n)
    for query in (dash.benchmark_comparison, dash.performance_stats, dash.vix_overlay):
        want, got = query(whole, n), query(some, n)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    files, months = some.inputFiles(), layout.months_of_latest(build.read_mart(spark, out, build.COUNTS), n)
    assert len(months) < 0.5 * len(published.files_of(spark, out, "fact_daily_metrics"))
    assert any(m < "1995-06" for m in months) and not any("1996-06" <= m < "1997-01" for m in months)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and len(files) > 0


def test_months_of_latest_by_brute_force(spark):
    rows = [("A", "2024-01", 3), ("A", "2024-02", 1), ("A", "2024-05", 1), ("B", "2020-01", 9),
            ("B", "2019-12", 9), ("C", "2024-05", 2)]
    counts = spark.createDataFrame(rows, "symbol string, month string, rows long")
    for n in (1, 2, 3, 10, 100):
        want = set()
        for symbol in "ABC":
            seen = 0
            for _, month, k in sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1], reverse=True):
                if seen < n:
                    want.add(month)
                seen += k
        assert layout.months_of_latest(counts, n) == sorted(want)
