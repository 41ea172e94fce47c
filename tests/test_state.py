"""State that survives concurrent writers, retries and breaks: watermarks, loads, published builds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators.aggregates import row_counts
from marketlake.schemas import WATERMARKS
from marketlake.sinks import append_log
from marketlake.sinks import raw_store as rs

NOW = dt.datetime(2024, 2, 1, 12)


def marks(spark, root):
    return {r.dataset_name: r.watermark_value for r in rs.read_watermarks(spark, root).collect()}


def test_interleaved_updates_keep_both(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/wm"
    assert rs.update_watermark(spark, root, "prices", "2024-01-01", NOW)
    real, inner = append_log.entries, []

    def entries(spark, path, schema):
        found = real(spark, path, schema)
        if not inner:  # another load sets its mark between this one's read and write
            inner.append(1)
            assert rs.update_watermark(spark, path, "benchmarks", "2024-01-03", NOW)
        return found

    monkeypatch.setattr(append_log, "entries", entries)
    assert rs.update_watermark(spark, root, "prices", "2024-01-02", NOW)
    assert marks(spark, root) == {"prices": "2024-01-02", "benchmarks": "2024-01-03"}


def test_the_later_update_counts_even_backwards(spark, tmp_dir):
    root = f"{tmp_dir}/wm"
    for value in ("2024-01-05", "2024-01-09", "2024-01-02"):
        assert rs.update_watermark(spark, root, "prices", value, NOW)
    assert marks(spark, root) == {"prices": "2024-01-02"}


def test_compaction_keeps_state_and_what_comes_meanwhile(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/wm"
    for k in range(4):
        rs.update_watermark(spark, root, f"d{k % 2}", str(k), NOW)
    real = append_log.entries

    def entries(spark, path, schema):
        found = real(spark, path, schema)
        monkeypatch.setattr(append_log, "entries", real)
        rs.update_watermark(spark, path, "d0", "new", NOW)
        return found

    monkeypatch.setattr(append_log, "entries", entries)
    assert append_log.compact(spark, root, WATERMARKS, ["dataset_name"]) == 4
    assert marks(spark, root) == {"d0": "new", "d1": "3"}
    assert append_log.compact(spark, root, WATERMARKS, ["dataset_name"]) == 2
    assert marks(spark, root) == {"d0": "new", "d1": "3"}


def rows(spark, days):
    return spark.createDataFrame([("A", dt.date(2024, 1, d), float(d)) for d in days],
                                 "symbol string, date date, close double")


@pytest.mark.parametrize("folders", [None, ["date"]])
def test_a_retried_load_replaces_its_rows(spark, tmp_dir, folders):
    raw, runs = f"{tmp_dir}/prices", f"{tmp_dir}/runs"

    def load(days, run_id):
        return rs.load_to_raw(rows(spark, days), raw, "prices", runs_path=runs, create_table=True,
                              run_id=run_id, partition_by=folders, log_start=True)

    def counts():
        return {r.table_name: r.row_count for r in row_counts({"prices": spark.read.parquet(raw)}).collect()}

    first = load([1, 2, 3], "run_a")
    assert first["chunks"] >= 1 and first["records_loaded"] == 3
    load([2, 3], "run_b")
    assert counts() == {"prices": 5}
    again = load([1, 2, 3], "run_a")
    assert counts() == {"prices": 5} and again["records_loaded"] == 3
    load([1, 2], "run_a")  # an attempt with fewer days leaves nothing of the earlier one
    assert counts() == {"prices": 4}
    stored = {(r.date.day, r.source_run_id) for r in spark.read.parquet(raw).collect()}
    assert stored == {(1, "run_a"), (2, "run_a"), (2, "run_b"), (3, "run_b")}
    log = spark.read.parquet(runs)
    assert log.filter("status = 'started'").count() == 4
    state = {r.run_id: (r.status, r.records_loaded) for r in rs.run_states(log).collect()}
    assert state == {"run_a": ("completed", 2), "run_b": ("completed", 2)}


def test_a_failed_attempt_is_replaced(spark, tmp_dir):
    raw, runs = f"{tmp_dir}/prices", f"{tmp_dir}/runs"
    bad = rows(spark, [1, 2]).withColumn(
        "close", F.when(F.col("close") > 1, F.raise_error("boom")).otherwise(F.col("close")))
    with pytest.raises(Exception):
        rs.load_to_raw(bad, raw, "prices", runs_path=runs, create_table=True, run_id="run_a")
    rs.load_to_raw(rows(spark, [1, 2]), raw, "prices", runs_path=runs, create_table=True, run_id="run_a")
    assert spark.read.parquet(raw).count() == 2
    assert [r.status for r in rs.run_states(spark.read.parquet(runs)).collect()] == ["completed"]


def test_tables_from_before_run_folders_are_appended_to(spark, tmp_dir):
    raw = f"{tmp_dir}/prices"
    rows(spark, [1, 2]).withColumn("source_run_id", F.lit("old")).write.parquet(raw)
    res = rs.load_to_raw(rows(spark, [3]), raw, "prices", run_id="run_a")
    assert res["records_loaded"] == 1 and res["chunks"] is None
    assert spark.read.parquet(raw).count() == 3


def test_run_ids_must_name_a_folder(spark, tmp_dir):
    with pytest.raises(ValueError):
        rs.load_to_raw(rows(spark, [1]), f"{tmp_dir}/p", "p", create_table=True, run_id="../x")


def test_run_record():
    record = rs.run_record("prices", now=NOW)
    assert record["status"] == "started" and record["records_loaded"] == 0
    assert record["run_id"].startswith("run_20240201_120000_") and record["error_message"] is None
