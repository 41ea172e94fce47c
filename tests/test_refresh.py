"""Incremental refresh against full rebuilds, and what readers see when publishing breaks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators.aggregates import pivot_benchmarks
from marketlake.operators.filters import arrived_since, incremental, late_rows
from marketlake.operators.quality import DataQualityError
from marketlake.plans import build, marts, refresh, staging
from marketlake.schemas import BENCHMARK_SERIES_DAILY, COMPANY_INFO, STOCK_PRICES_DAILY
from marketlake.sinks import published
from marketlake.sinks.raw_store import load_to_raw

DAY = dt.date(2024, 1, 20)
T0 = dt.datetime(2024, 3, 1)
TABLES = {"stock_prices_daily": STOCK_PRICES_DAILY, "benchmark_series_daily": BENCHMARK_SERIES_DAILY,
          "company_info": COMPANY_INFO}


def random_batch(rng, load):
    """Rows of one load, arrived at its hour: new days, corrections, gaps, new symbols, errors."""
    at = T0 + dt.timedelta(hours=load)
    run = f"run_{load:03d}"

    def day():
        return DAY + dt.timedelta(days=rng.randrange(45))  # three months

    def price():
        return rng.choice([0.0, 1.0, 2.5, 4.0, 8.0])

    prices = []
    for _ in range(rng.randrange(1, 14)):
        close = price()
        prices.append((rng.choice("ABCDEF"[:2 + load]), day(), price(), price(), price(), close, close,
                       rng.randrange(9), at, run))
    bench = [(rng.choice(["^GSPC", "^VIX", "XLK"]), day(), price(), at, run)
             for _ in range(rng.randrange(5))]
    company = []
    for symbol in rng.sample("ABCDEF", rng.randrange(3)):
        row = [None] * len(COMPANY_INFO.fields)
        row[0:5] = [symbol, "n", rng.choice(["s", "t"]), "i", rng.choice([10 ** 8, 10 ** 10, 10 ** 12])]
        row[-3:] = [at, run, rng.choice([None, None, "failed"])]
        company.append(tuple(row))
    return {"stock_prices_daily": prices, "benchmark_series_daily": bench, "company_info": company}


def frames(spark, data):
    # one task a table: these frames hold a few rows
    return {t: spark.createDataFrame(data[t], s).coalesce(1) for t, s in TABLES.items()}


def models(raw):
    company = staging.stg_company_info(raw["company_info"])
    bench = staging.stg_benchmark_series(raw["benchmark_series_daily"])
    fact = marts.fact_daily_metrics(staging.stg_stock_prices(raw["stock_prices_daily"]), company, bench)
    return fact, pivot_benchmarks(bench), company


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*marts.FACT_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", [0, 1, 2, 5])
def test_refresh_equals_rebuild(spark, seed):
    rng = random.Random(seed)
    batches = [random_batch(rng, k) for k in range(4)]
    data = {t: sum((b[t] for b in batches[:3]), []) for t in TABLES}
    if seed == 5:
        data = {t: [] for t in TABLES}  # the first load ever
    old, old_pivot, old_company = models(frames(spark, data))
    raw = frames(spark, {t: data[t] + batches[3][t] for t in TABLES})
    fact, pivot, company = models(raw)
    arrived = arrived_since(raw["stock_prices_daily"], str(T0 + dt.timedelta(hours=2)))
    rows = refresh.changed_rows(old, refresh.new_versions(raw["stock_prices_daily"], arrived),
                                old_pivot, pivot, old_company, company)
    want = rows_of(fact)
    assert rows_of(refresh.refreshed(old, rows)) == want
    # the closure is whole, and no more than the rows that could have changed
    before = set(rows_of(old))
    assert set(want) - before <= set(rows_of(rows))


def load(spark, root, batch, k):
    for table, frame in frames(spark, batch).items():
        load_to_raw(frame.drop("source_run_id"), f"{root}/{table}", table, create_table=True,
                    run_id=f"run_{k:03d}", partition_by=["date"] if "date" in frame.columns else None)


@pytest.fixture()
def marts_of_two_loads(spark, tmp_dir):
    """Raw tables of two loads, of which the published marts know the first."""
    rng = random.Random(11)
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/marts"
    first, second = random_batch(rng, 0), random_batch(rng, 1)
    first["benchmark_series_daily"] = [("^GSPC", DAY, 1.0, T0, "r"), ("^GSPC", dt.date(2024, 3, 2), 2.0, T0, "r")]
    row = [None] * len(COMPANY_INFO.fields)
    row[0], row[-3], row[-2] = "A", T0, "r"
    first["company_info"] = [tuple(row)]
    # the second load changes one day of February alone
    at = T0 + dt.timedelta(days=3)
    second = {"stock_prices_daily": [("Z", dt.date(2024, 2, 10), 1.0, 1.0, 1.0, 1.0, 1.0, 1, at, "r")],
              "benchmark_series_daily": [], "company_info": []}
    first["stock_prices_daily"] += [(s, d, 1.0, 1.0, 1.0, 2.0, 2.0, 1, T0, "r")
                                    for s in "AZ" for d in (DAY, dt.date(2024, 2, 9), dt.date(2024, 3, 1))]
    load(spark, raw, first, 0)
    build.build_marts(spark, raw, out, as_of="2024-03-05")
    load(spark, raw, second, 1)
    return raw, out


def fact(spark, out):
    return build.read_fact(spark, f"{out}/fact_daily_metrics")


def rebuilt(spark, raw):
    prices, bench, company = build.staged(spark, raw)
    return rows_of(marts.fact_daily_metrics(prices, company, bench))


def test_refresh_writes_the_changed_months(spark, marts_of_two_loads):
    raw, out = marts_of_two_loads
    before = published.files_of(spark, out, "fact_daily_metrics")
    res = refresh.refresh_marts(spark, raw, out, overlap_days=0)
    after = published.files_of(spark, out, "fact_daily_metrics")
    # the new row and its successor in March; January's files are those of the build
    assert res["months"] == ["2024-02", "2024-03"] and res["changed_rows"] == 2
    assert [f for f in before if f in after] == [f for f in before if "2024-01" in f] != []
    assert len(after) == 3
    assert rows_of(fact(spark, out)) == rebuilt(spark, raw)
    assert build.read_mart(spark, out, build.MARKS).first()["ingest_mark"] == str(T0 + dt.timedelta(days=3))
    again = refresh.refresh_marts(spark, raw, out)  # the overlap: seen rows are derived again
    assert rows_of(fact(spark, out)) == rebuilt(spark, raw) and again["changed_rows"] >= 2


def test_a_refresh_that_breaks_half_way_leaves_the_old_set(spark, marts_of_two_loads, monkeypatch):
    raw, out = marts_of_two_loads
    old = rows_of(fact(spark, out))
    real = published.publish

    def broken(*args, **kwargs):
        raise OSError("lost the driver")

    monkeypatch.setattr(published, "publish", broken)
    with pytest.raises(OSError):
        refresh.refresh_marts(spark, raw, out)
    with pytest.raises(OSError):
        build.build_marts(spark, raw, out, as_of="2024-03-05")
    monkeypatch.setattr(published, "publish", real)
    assert rows_of(fact(spark, out)) == old
    assert len(published.sweep(spark, out)) == 2 and rows_of(fact(spark, out)) == old
    refresh.refresh_marts(spark, raw, out)
    assert rows_of(fact(spark, out)) == rebuilt(spark, raw)


def test_failed_checks_are_not_published(spark, marts_of_two_loads):
    raw, out = marts_of_two_loads
    old = rows_of(fact(spark, out))
    bad = spark.createDataFrame([("Q", DAY, None, None, None, None, None, 1, T0 + dt.timedelta(days=9))],
                                "symbol string, date date, open double, high double, low double, "
                                "close double, adj_close double, volume bigint, ingested_at timestamp_ntz")
    load_to_raw(bad, f"{raw}/stock_prices_daily", "p", run_id="run_bad", partition_by=["date"])
    with pytest.raises(DataQualityError):
        refresh.refresh_marts(spark, raw, out)
    assert rows_of(fact(spark, out)) == old


def test_a_reader_sees_whole_sets(spark, tmp_dir):
    """Two tables of two builds: at no time is one of the first seen with one of the second."""
    for build_id in ("build-a", "build-b"):
        for name in ("dim", "fact"):
            spark.range(1).select(F.lit(build_id).alias("id")).write.parquet(f"{tmp_dir}/{build_id}/{name}")
        assert {r.path.split("/")[0] for r in published.current(spark, tmp_dir).collect()} <= {"build-a"}
        published.publish(spark, tmp_dir, {n: f"{tmp_dir}/{build_id}/{n}" for n in ("dim", "fact")})
        assert {published.read_published(spark, tmp_dir, n).first().id for n in ("dim", "fact")} == {build_id}
    with pytest.raises(ValueError):
        published.publish(spark, tmp_dir, {"x": "/elsewhere/x"})


def test_parts_of_an_older_whole_table_are_gone(spark, tmp_dir):
    def write(build_id, months):
        path = f"{tmp_dir}/{build_id}/fact"
        spark.createDataFrame([(m, build_id) for m in months], "month string, v string") \
            .write.partitionBy("month").parquet(path)
        return {"fact": path}, {"fact": published.parts_of(spark, path, "month")}

    def seen():
        return {(r.month, r.v) for r in published.read_published(spark, tmp_dir, "fact").collect()}

    published.publish(spark, tmp_dir, *write("build-a", ["2024-01", "2024-02"]))
    published.publish(spark, tmp_dir, *write("build-b", ["2024-02", "2024-03"]), whole=False)
    assert seen() == {("2024-01", "build-a"), ("2024-02", "build-b"), ("2024-03", "build-b")}
    published.publish(spark, tmp_dir, *write("build-c", ["2024-03"]))
    assert seen() == {("2024-03", "build-c")}


def test_late_rows_are_those_that_a_date_mark_drops(spark):
    rows = [("A", dt.date(2024, 1, d), T0 + dt.timedelta(hours=h)) for d, h in ((1, 0), (9, 0), (2, 5), (10, 5))]
    df = spark.createDataFrame(rows, "symbol string, date date, ingested_at timestamp_ntz")
    late = late_rows(df, "2024-01-09", str(T0 + dt.timedelta(hours=1)))
    assert [r.date.day for r in late.collect()] == [2]
    assert sorted(r.date.day for r in incremental(df, "2024-01-09").unionAll(late).collect()) == [2, 10]
    assert arrived_since(df, None).count() == 4
    assert arrived_since(df, str(T0 + dt.timedelta(hours=25)), overlap_days=1).count() == 2
