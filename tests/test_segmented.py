"""Windows by entity and year against windows by entity."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketlake.operators.windows import diff, entity_window, moving_avg, pct_change, segmented
from marketlake.plans import staging
from marketlake.sources import fixtures as fx


def series(rng):
    """Series with years of no, one and many rows."""
    rows = []
    for symbol in "ABCD":
        for year in range(2000, 2012):
            days = rng.sample(range(365), rng.choice([0, 0, 1, 1, 2, 3, 30]))
            rows += [(symbol, dt.date(year, 1, 1) + dt.timedelta(days=d), rng.choice([0.0, 1.0, 2.5, None]))
                     for d in days]
    rows.append(("D", None, 7.0))
    return rows


@pytest.mark.parametrize("seed, reach", [(1, 1), (2, 4), (3, 19)])
def test_equals_entity_windows(spark, seed, reach):
    df = spark.createDataFrame(series(random.Random(seed)), "symbol string, date date, x double")

    def metrics(frame, w):
        return frame.select("*", diff("x", w).alias("d"), pct_change("x", w).alias("p"),
                            moving_avg("x", w, reach + 1).alias("m"))

    want = metrics(df, entity_window(["symbol"]))
    cut = metrics(segmented(df, ["symbol"], reach), entity_window(["symbol", "segment"]))
    got = cut.filter(~F.col("carried")).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # every segment carries the rows before it, and no more than it needs
    sizes = cut.groupBy("symbol", "segment").agg(F.sum(F.col("carried").cast("int")).alias("c")).collect()
    before = {}
    for r in sorted(sizes, key=lambda r: (r.symbol, r.segment)):
        own = cut.filter((F.col("symbol") == r.symbol) & (F.col("segment") == r.segment) & ~F.col("carried")).count() \
            if reach == 4 else None
        if own is not None:
            assert r.c == min(reach, before.get(r.symbol, 0))
            before[r.symbol] = before.get(r.symbol, 0) + own


def test_a_task_holds_a_year(spark):
    raw = fx.raw_long_prices(spark, SF_SMALL)
    one = raw.withColumn("symbol", F.lit("hot"))
    plain = staging.stg_stock_prices(one, fx.LONG_HISTORY_TIE)
    cut = staging.stg_stock_prices(one, fx.LONG_HISTORY_TIE, by_year=True)
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()
    rows = plain.count()
    largest = segmented(plain.select("symbol", "date"), ["symbol"], 4).groupBy("symbol", "segment").count() \
        .agg(F.max("count")).first()[0]
    assert rows > 2000 and largest <= 366 + 4


def test_benchmarks_by_year(spark):
    raw = fx.raw_benchmarks(spark, SF_SMALL).withColumn("date", F.expr("date + (dayofmonth(date) * 100)"))
    plain, cut = staging.stg_benchmark_series(raw), staging.stg_benchmark_series(raw, by_year=True)
    assert cut.columns == plain.columns and cut.count() == plain.count() > 0
    assert cut.exceptAll(plain).isEmpty()


def test_empty(spark):
    df = spark.createDataFrame([], "symbol string, date date, x double")
    assert segmented(df, ["symbol"], 4).collect() == []
