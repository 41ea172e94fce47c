"""End-to-end: land the fixture raw tables, build the marts, compare with the lazy queries."""

import pytest

from conftest import SF_SMALL
from marketlake.operators.quality import DataQualityError
from marketlake.plans import build, catalog
from marketlake.sources import fixtures as fx


@pytest.fixture()
def raw_root(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    fx.raw_prices(spark, SF_SMALL).write.parquet(f"{root}/stock_prices_daily")
    fx.raw_company(spark, SF_SMALL).write.parquet(f"{root}/company_info")
    fx.raw_benchmarks(spark, SF_SMALL).write.parquet(f"{root}/benchmark_series_daily")
    return root


def test_build_marts_matches_queries(spark, raw_root, tmp_dir):
    out = f"{tmp_dir}/marts"
    res = build.build_marts(spark, raw_root, out, as_of="2024-02-08")
    assert res["pivot_rows"] == 30
    fact = build.read_fact(spark, f"{out}/fact_daily_metrics")
    lazy = catalog.fact(spark, SF_SMALL)
    assert fact.columns == lazy.columns
    assert fact.exceptAll(lazy).count() == 0 and lazy.exceptAll(fact).count() == 0
    assert res["fact_rows"] == fact.count()
    statuses = {(c["check_name"], c["object_name"], c["column_name"]): c["status"]
                for c in res["checks"]}
    assert statuses[("freshness", "stock_prices_daily", "date")] == "warn"
    assert all(s in ("pass", "warn") for s in statuses.values())


def test_build_fails_on_failed_check(spark, raw_root, tmp_dir):
    from pyspark.sql import functions as F
    prices = spark.read.parquet(f"{raw_root}/stock_prices_daily")
    prices.limit(3).withColumn("close", F.lit(None).cast("double")) \
        .write.mode("append").parquet(f"{raw_root}/stock_prices_daily")
    with pytest.raises(DataQualityError):
        build.build_marts(spark, raw_root, f"{tmp_dir}/marts2", as_of="2024-02-01")


def test_build_checks_equal_lazy_suite(spark, raw_root, tmp_dir):
    """The observed-on-write checks give the same table as the lazy suite."""
    res = build.build_marts(spark, raw_root, f"{tmp_dir}/marts3", as_of="2024-02-08")
    lazy = catalog.QUERIES["data_quality"](spark, SF_SMALL)
    got = sorted(tuple(r[k] for k in ("check_name", "object_name", "column_name", "observed",
                                       "status")) for r in res["checks"])
    assert got == sorted(tuple(r) for r in lazy.select("check_name", "object_name",
                                                       "column_name", "observed",
                                                       "status").collect())


def test_failed_build_leaves_the_live_tables(spark, raw_root, tmp_dir):
    from pyspark.sql import functions as F
    out = f"{tmp_dir}/marts4"
    build.build_marts(spark, raw_root, out, as_of="2024-02-08")
    before = build.read_fact(spark, f"{out}/fact_daily_metrics").count()
    prices = spark.read.parquet(f"{raw_root}/stock_prices_daily")
    prices.limit(3).withColumn("close", F.lit(None).cast("double")) \
        .write.mode("append").parquet(f"{raw_root}/stock_prices_daily")
    with pytest.raises(DataQualityError):
        build.build_marts(spark, raw_root, out, as_of="2024-02-08")
    assert build.read_fact(spark, f"{out}/fact_daily_metrics").count() == before
    res = build.build_marts(spark, raw_root, out, as_of="2024-02-08", fail_on_error=False)
    assert res["fact_rows"] == build.read_fact(spark, f"{out}/fact_daily_metrics").count()


def test_fact_prunes_months(spark, raw_root, tmp_dir):
    out = f"{tmp_dir}/marts5"
    build.build_marts(spark, raw_root, out, as_of="2024-02-08")
    some = build.read_fact(spark, f"{out}/fact_daily_metrics", since="2024-01-20")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert 0 < some.count() < build.read_fact(spark, f"{out}/fact_daily_metrics").count()
