"""Append loads, run log, watermarks, incremental filter, SQL and materialisation."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marketlake.operators.filters import incremental
from marketlake.plans import staging
from marketlake.schemas import STOCK_PRICES_DAILY, WATERMARKS
from marketlake.sinks import raw_store as rs

D = dt.date
NOW = dt.datetime(2024, 2, 1, 12, 0, 0)


def batch(spark, rows):
    """rows: (symbol, date as datetime, close) as an extracted batch (date still a timestamp)."""
    return spark.createDataFrame(
        [(s, d, c, c, c, c, c, 1, NOW) for s, d, c in rows],
        "symbol string, date timestamp_ntz, open double, high double, low double, close double, "
        "adj_close double, volume bigint, ingested_at timestamp_ntz")


def test_run_id_format():
    rid = rs.generate_run_id(NOW)
    assert re.fullmatch(r"run_20240201_120000_[0-9a-f]{8}", rid)


def test_coerce_dates_matches_names_containing_date(spark):
    df = spark.createDataFrame([(NOW, NOW, NOW)], "date timestamp_ntz, updated_at timestamp_ntz, "
                                                 "ingested_at timestamp_ntz")
    types = dict(rs.coerce_dates(df).dtypes)
    assert types == {"date": "date", "updated_at": "date", "ingested_at": "timestamp_ntz"}


def test_load_append_runlog_and_dedup(spark, tmp_dir):
    raw, runs = f"{tmp_dir}/stock_prices_daily", f"{tmp_dir}/ingest_runs"
    b1 = batch(spark, [("A", dt.datetime(2024, 1, 1), 1.0), ("A", dt.datetime(2024, 1, 2), 2.0)])
    with pytest.raises(FileNotFoundError):
        rs.load_to_raw(b1, raw, "stock_prices", runs_path=runs)       # create_table=False
    rs.create_table(spark, raw, STOCK_PRICES_DAILY)
    r1 = rs.load_to_raw(b1, raw, "stock_prices", runs_path=runs, now=NOW)
    assert r1["status"] == "completed" and r1["records_loaded"] == 2
    assert r1["watermark"] == "2024-01-02 00:00:00"    # str of the timestamp, before coercion
    # second load corrects day 2 and adds day 3
    b2 = batch(spark, [("A", dt.datetime(2024, 1, 2), 2.5), ("A", dt.datetime(2024, 1, 3), 3.0)])
    r2 = rs.load_to_raw(b2.withColumn("ingested_at", F.lit(dt.datetime(2024, 2, 2))
                                      .cast("timestamp_ntz")), raw, "stock_prices", runs_path=runs)
    assert r2["records_loaded"] == 2
    empty = rs.load_to_raw(b1.limit(0), raw, "stock_prices", runs_path=runs)
    assert empty == {"records_loaded": 0, "status": "skipped"}
    stored = spark.read.parquet(raw)
    assert stored.count() == 4 and dict(stored.dtypes)["date"] == "date"
    assert stored.select("source_run_id").distinct().count() == 2
    latest = {r.date.day: r.close for r in staging.stg_stock_prices(stored).collect()}
    assert latest == {1: 1.0, 2: 2.5, 3: 3.0}
    log = spark.read.parquet(runs).collect()
    assert sorted(r.status for r in log) == ["completed", "completed"]   # no row for skipped


def test_failed_load_is_logged_and_reraised(spark, tmp_dir):
    raw, runs = f"{tmp_dir}/prices", f"{tmp_dir}/runs"
    rs.create_table(spark, raw, STOCK_PRICES_DAILY)
    bad = batch(spark, [("A", dt.datetime(2024, 1, 1), 1.0)]).withColumn(
        "close", F.when(F.col("close") > 0, F.raise_error("boom")).otherwise(F.col("close")))
    with pytest.raises(Exception):
        rs.load_to_raw(bad, raw, "prices", runs_path=runs, create_table=True)
    log = spark.read.parquet(runs).first()
    assert (log.status, log.records_loaded) == ("failed", 0) and "boom" in log.error_message


def test_watermark_upsert_semantics(spark):
    cur = spark.createDataFrame([("prices", "2024-01-10", NOW), ("bench", "2024-01-09", NOW)],
                                WATERMARKS)
    upd = spark.createDataFrame([("prices", "2024-01-05", NOW), ("company", "2024-01-11", NOW)],
                                WATERMARKS)
    out = {r.dataset_name: r.watermark_value for r in rs.upsert_watermark(cur, upd).collect()}
    # existing updated (even backwards), new inserted, untouched kept
    assert out == {"prices": "2024-01-05", "bench": "2024-01-09", "company": "2024-01-11"}
    twice = rs.upsert_watermark(rs.upsert_watermark(cur, upd), upd)
    assert sorted(twice.collect()) == sorted(rs.upsert_watermark(cur, upd).collect())


def test_watermark_store_versions(spark, tmp_dir):
    root = f"{tmp_dir}/watermarks"
    assert rs.get_watermark(spark, root, "prices") is None
    assert rs.update_watermark(spark, root, "prices", "2024-01-10", NOW)
    assert rs.update_watermark(spark, root, "bench", "2024-01-09", NOW)
    assert rs.update_watermark(spark, root, "prices", "2024-01-12", NOW)
    assert rs.get_watermark(spark, root, "prices") == "2024-01-12"
    assert rs.get_watermark(spark, root, "bench") == "2024-01-09"
    assert rs.read_watermarks(spark, root).count() == 2
    assert rs._versions(spark, root).select("version").distinct().count() == 3


def test_incremental_filter(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3)], "date date")
    assert incremental(df, "2024-01-02").count() == 1
    assert incremental(df, None).count() == 3
    state = spark.createDataFrame([("prices", "2024-01-01", NOW)], WATERMARKS)
    assert incremental(df, rs.watermark_column(state, "prices")).count() == 2
    assert incremental(df, rs.watermark_column(state, "none")).count() == 3


def test_run_sql_binds_parameters(spark):
    spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, v int") \
        .createOrReplaceTempView("t_params")
    out = rs.run_sql(spark, "SELECT v FROM t_params WHERE symbol = :sym", sym="B' OR '1'='1")
    assert out.count() == 0
    assert rs.run_sql(spark, "SELECT v FROM t_params WHERE symbol = :sym", sym="B").first().v == 2


def test_materialise(spark, tmp_dir):
    df = spark.range(3)
    assert rs.materialise(df, "m_view").count() == 3
    t = rs.materialise(df, "m_table", "table", f"{tmp_dir}/m")
    assert t.count() == 3 and spark.table("m_table").count() == 3
    rs.materialise(spark.range(2), "m_table", "table", f"{tmp_dir}/m")
    assert spark.read.parquet(f"{tmp_dir}/m").count() == 2
    with pytest.raises(ValueError):
        rs.materialise(df, "x", "table")


def test_date_partitioned_raw_prunes_above_watermark(spark, tmp_dir):
    raw = f"{tmp_dir}/prices_by_day"
    b = batch(spark, [("A", dt.datetime(2024, 1, d), float(d)) for d in range(1, 6)])
    rs.load_to_raw(b, raw, "prices", create_table=True, partition_by=["date"])
    stored = spark.read.parquet(raw)
    assert dict(stored.dtypes)["date"] == "date"
    state = spark.createDataFrame([("prices", "2024-01-03", NOW)], WATERMARKS)
    inc = incremental(stored, rs.watermark_column(state, "prices"))
    assert sorted(r.date.day for r in inc.collect()) == [4, 5]
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*date[^\n]*Subquery", plan)


def test_batch_watermarks_per_dataset(spark):
    df = spark.createDataFrame(
        [("prices", D(2024, 1, 2), NOW), ("prices", D(2024, 1, 5), NOW), ("bench", None, NOW)],
        "ds string, date date, ingested_at timestamp_ntz")
    out = {r.dataset_name: r.watermark_value for r in rs.batch_watermarks(df, "ds").collect()}
    assert out == {"prices": "2024-01-05", "bench": None}


def test_run_log_holds_more_than_32_bits(spark, tmp_dir):
    assert rs.log_run(spark, f"{tmp_dir}/runs", "r", "prices", "t", 3_000_000_000, "completed", now=NOW)
    assert spark.read.parquet(f"{tmp_dir}/runs").first().records_loaded == 3_000_000_000
    assert rs.run_completed(spark, f"{tmp_dir}/runs", "r")
    assert not rs.run_completed(spark, f"{tmp_dir}/runs", "s")
    assert not rs.run_completed(spark, f"{tmp_dir}/none", "r")


def test_watermark_survives_a_crashed_write(spark, tmp_dir):
    import os
    root = f"{tmp_dir}/wm"
    os.makedirs(f"{root}/state-dead/_temporary/0")
    assert rs.get_watermark(spark, root, "a") is None
    assert rs.update_watermark(spark, root, "a", "2024-01-01", NOW)
    os.makedirs(f"{root}/state-dead2/_temporary/0")
    assert rs.update_watermark(spark, root, "a", "2024-01-02", NOW)
    assert rs.update_watermark(spark, root, "b", "2024-01-03", NOW)
    assert rs.get_watermark(spark, root, "a") == "2024-01-02"
    assert rs.get_watermark(spark, root, "b") == "2024-01-03"


def test_few_files_per_day(spark, tmp_dir):
    import glob
    df = spark.range(8000).selectExpr("cast(id as string) symbol",
                                      "date_add(date'2024-01-01', cast(id % 40 as int)) date")
    rs.load_to_raw(df.repartition(8), f"{tmp_dir}/t", "p", create_table=True, partition_by=["date"])
    assert len(glob.glob(f"{tmp_dir}/t/date=*")) == 40
    assert len(glob.glob(f"{tmp_dir}/t/date=*/part-*")) <= 80
