"""Landed-file ingestion with an availableNow stream."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketlake.plans import staging
from marketlake.sinks import raw_store as rs
from marketlake.sources import fixtures as fx
from marketlake.streaming.landing import ingest_landed


def test_only_new_files_are_loaded(spark, tmp_dir):
    landing, raw = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    runs, wm, ckpt = f"{tmp_dir}/runs", f"{tmp_dir}/wm", f"{tmp_dir}/ckpt"
    prices = fx.raw_prices(spark, SF_SMALL).drop("source_run_id")
    schema = prices.schema
    first = prices.filter(F.col("date") <= "2024-01-15")
    second = prices.filter(F.col("date") > "2024-01-15")
    first.coalesce(2).write.parquet(f"{landing}/part1")
    kw = dict(runs_path=runs, watermark_root=wm, checkpoint=ckpt)
    r1 = ingest_landed(spark, f"{landing}/*", schema, raw, "stock_prices", **kw)
    assert sum(r["records_loaded"] for r in r1) == first.count()
    assert rs.get_watermark(spark, wm, "stock_prices") == "2024-01-15"
    # nothing new: no micro-batch loads anything
    r_none = ingest_landed(spark, f"{landing}/*", schema, raw, "stock_prices", **kw)
    assert sum(r.get("records_loaded", 0) for r in r_none) == 0
    second.coalesce(2).write.parquet(f"{landing}/part2")
    ingest_landed(spark, f"{landing}/*", schema, raw, "stock_prices", **kw)
    stored = spark.read.parquet(raw)
    assert stored.count() == prices.count()
    assert rs.get_watermark(spark, wm, "stock_prices") == "2024-01-30"
    assert spark.read.parquet(runs).filter("status = 'completed'").count() >= 2
    # the landed history stages to the same model as the source table
    a = staging.stg_stock_prices(stored).select("symbol", "date", "close", "daily_return")
    b = staging.stg_stock_prices(fx.raw_prices(spark, SF_SMALL)).select(
        "symbol", "date", "close", "daily_return")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cli_ingest_then_build(spark, tmp_dir):
    from marketlake import cli
    from marketlake.sources import fixtures as fx
    root, landing = f"{tmp_dir}/raw", f"{tmp_dir}/landing"
    for table, df in (("stock_prices_daily", fx.raw_prices(spark, SF_SMALL)),
                      ("company_info", fx.raw_company(spark, SF_SMALL)),
                      ("benchmark_series_daily", fx.raw_benchmarks(spark, SF_SMALL))):
        schema = cli._landed_schema(table)
        cast = [F.col(f.name).cast(f.dataType) for f in schema.fields]
        df.select(*cast).write.parquet(f"{landing}/{table}/batch1")
        out = cli.main(["ingest", "--landing", f"{landing}/{table}/*", "--table", table,
                        "--root", root])
        assert sum(b.get("records_loaded", 0) for b in out["batches"]) == df.count()
    ver = cli.main(["verify", "--root", root, "--as-of", "2024-02-08"])["checks"]
    assert {(c["object_name"], c["check_name"]): c["status"] for c in ver} == {
        ("stock_prices_daily", "non_empty"): "pass", ("stock_prices_daily", "freshness"): "warn",
        ("company_info", "non_empty"): "pass", ("benchmark_series_daily", "non_empty"): "pass"}
    res = cli.main(["build", "--root", root, "--out", f"{tmp_dir}/marts", "--as-of", "2024-02-08"])
    assert res["fact_rows"] == fx.raw_prices(spark, SF_SMALL).select("symbol", "date") \
        .distinct().count()
    assert rs.get_watermark(spark, f"{root}/watermarks", "benchmark_series") == "2024-01-30"


def test_cli_verify_fails_on_an_empty_raw_table(spark, tmp_dir):
    import pytest

    from marketlake import cli
    from marketlake.operators.quality import DataQualityError
    from marketlake.schemas import RAW_TABLES
    root = f"{tmp_dir}/raw"
    for table in cli.DATASETS:
        rs.create_table(spark, f"{root}/{table}", RAW_TABLES[table])
    with pytest.raises(DataQualityError):
        cli.main(["verify", "--root", root, "--as-of", "2024-02-08"])


def test_replayed_load_is_absorbed_by_the_dedup(spark, tmp_dir):
    """Two streams (as after losing a checkpoint) load the same files twice; staging is
    unchanged because latest-wins keeps one row per (symbol, date)."""
    landing, raw = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    prices = fx.raw_prices(spark, SF_SMALL).drop("source_run_id")
    prices.coalesce(2).write.parquet(f"{landing}/part1")
    for ckpt in ("ckpt_a", "ckpt_b"):
        ingest_landed(spark, f"{landing}/*", prices.schema, raw, "stock_prices",
                      checkpoint=f"{tmp_dir}/{ckpt}")
    stored = spark.read.parquet(raw)
    assert stored.count() == 2 * prices.count()
    cols = ["symbol", "date", "close", "daily_return", "volume_ma5"]
    once = staging.stg_stock_prices(fx.raw_prices(spark, SF_SMALL)).select(*cols)
    twice = staging.stg_stock_prices(stored).select(*cols)
    assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0


def test_each_raw_table_keeps_its_own_account(spark, tmp_dir):
    """No checkpoint named: a second run loads nothing, another raw table gets every file."""
    landing = f"{tmp_dir}/landing"
    df = fx.raw_prices(spark, SF_SMALL).drop("source_run_id")
    df.coalesce(2).write.parquet(f"{landing}/a")
    for root in ("one", "two"):
        first = ingest_landed(spark, f"{landing}/*", df.schema, f"{tmp_dir}/{root}/prices", "p",
                              runs_path=f"{tmp_dir}/{root}/runs")
        assert sum(r["records_loaded"] for r in first) == df.count()
        assert all(r["logged"] for r in first)
        again = ingest_landed(spark, f"{landing}/*", df.schema, f"{tmp_dir}/{root}/prices", "p",
                              runs_path=f"{tmp_dir}/{root}/runs")
        assert sum(r["records_loaded"] for r in again) == 0
        assert spark.read.parquet(f"{tmp_dir}/{root}/prices").count() == df.count()


def test_cli_ingests_downloads(spark, tmp_dir):
    """Wide, single and document extracts land as rows of the raw tables."""
    from marketlake import cli
    from marketlake.sources import reshape
    wide = fx.wide_bars_with_gaps(spark, SF_SMALL)
    wide.coalesce(1).write.parquet(f"{tmp_dir}/wide/a")
    tickers = ["view", "click", "gone"]
    args = ["ingest", "--table", "stock_prices_daily", "--root", f"{tmp_dir}/raw", "--landing",
            f"{tmp_dir}/wide/*", "--shape", "wide-prices", "--symbols", ",".join(tickers)]
    out = cli.main([*args, "--start", "2024-01-05", "--end", "2024-01-20"])
    want = reshape.prices_long(wide, tickers).where("date >= '2024-01-05' AND date < '2024-01-20'")
    stored = spark.read.parquet(f"{tmp_dir}/raw/stock_prices_daily")
    cols = reshape.PRICE_LONG_COLUMNS
    assert sorted(stored.select(cols).collect()) == sorted(want.select(cols).collect())
    assert sum(b["records_loaded"] for b in out["batches"]) == want.count() > 0
    assert stored.where("ingested_at IS NULL OR source_run_id IS NULL").count() == 0

    fx.flat_download(spark, SF_SMALL, "error").coalesce(1).write.parquet(f"{tmp_dir}/vix/a")
    cli.main(["ingest", "--table", "benchmark_series_daily", "--root", f"{tmp_dir}/raw", "--landing",
              f"{tmp_dir}/vix/*", "--shape", "single-benchmark", "--symbols", "^VIX",
              "--period", "5d", "--as-of", "2024-01-30"])
    dates = spark.read.parquet(f"{tmp_dir}/raw/benchmark_series_daily").select("date").collect()
    assert dates and min(str(r.date) for r in dates) >= "2024-01-26"

    fx.number_documents(spark, SF_SMALL).drop("ingested_at").coalesce(1).write.parquet(
        f"{tmp_dir}/docs/a")
    cli.main(["ingest", "--table", "company_info", "--root", f"{tmp_dir}/raw", "--landing",
              f"{tmp_dir}/docs/*", "--shape", "profiles", "--symbols", "1,2,3,11"])
    rows = spark.read.parquet(f"{tmp_dir}/raw/company_info").collect()
    assert sorted(r.symbol for r in rows) == [1, 2, 3, 11]
    assert {r.symbol: r.error for r in rows}[3] == "unreadable fields: marketCap"
