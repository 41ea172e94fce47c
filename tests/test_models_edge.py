"""Edge frames of FIXTURES.md section 4 for the staging models and the marts."""

import datetime as dt
import math

from pyspark.sql import functions as F

from marketlake.functions.expressions import cap_category
from marketlake.plans import marts, staging
from marketlake.schemas import BENCHMARK_SERIES_DAILY, COMPANY_INFO, STOCK_PRICES_DAILY

D = dt.date
TS = dt.datetime


def prices(spark, rows):
    """rows: (symbol, date, open, high, low, close, volume, ingested_at, run_id)."""
    full = [(s, d, o, h, lo, c, c, v, ts, r) for s, d, o, h, lo, c, v, ts, r in rows]
    return spark.createDataFrame(full, STOCK_PRICES_DAILY)


def bench(spark, rows):
    return spark.createDataFrame(rows, BENCHMARK_SERIES_DAILY)


def company(spark, rows):
    """rows: (symbol, name, sector, market_cap, ingested_at, run_id, error)."""
    width = len(COMPANY_INFO.fields)
    out = []
    for sym, name, sector, cap, ts, run, err in rows:
        r = [None] * width
        r[0], r[1], r[2], r[3], r[4] = sym, name, sector, "ind", cap
        r[-3], r[-2], r[-1] = ts, run, err
        out.append(tuple(r))
    return spark.createDataFrame(out, COMPANY_INFO)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_latest_version_out_of_order_and_tie(spark):
    t = TS(2024, 1, 2)
    raw = prices(spark, [
        ("A", D(2024, 1, 1), 1.0, 1.0, 1.0, 10.0, 1, TS(2024, 1, 1), "run_1"),
        ("A", D(2024, 1, 1), 1.0, 1.0, 1.0, 30.0, 1, TS(2024, 1, 3), "run_3"),
        ("A", D(2024, 1, 1), 1.0, 1.0, 1.0, 20.0, 1, t, "run_2"),
        # equal ingest time: the larger run id wins
        ("B", D(2024, 1, 1), 1.0, 1.0, 1.0, 5.0, 1, t, "run_a"),
        ("B", D(2024, 1, 1), 1.0, 1.0, 1.0, 6.0, 1, t, "run_b"),
        # unknown ingest time never beats a known one
        ("C", D(2024, 1, 1), 1.0, 1.0, 1.0, 7.0, 1, None, "run_z"),
        ("C", D(2024, 1, 1), 1.0, 1.0, 1.0, 8.0, 1, t, "run_a"),
    ])
    out = by_key(staging.stg_stock_prices(raw), "symbol")
    assert out[("A",)]["close"] == 30.0
    assert out[("B",)]["close"] == 6.0
    assert out[("C",)]["close"] == 8.0


def test_zero_guards_and_first_row(spark):
    t = TS(2024, 1, 10)
    raw = prices(spark, [
        ("A", D(2024, 1, 1), 1.0, 2.0, 1.0, 0.0, 10, t, "r"),   # close 0
        ("A", D(2024, 1, 2), 1.0, 2.0, 1.0, 5.0, 20, t, "r"),   # previous close 0
        ("A", D(2024, 1, 5), 4.0, 6.0, 4.0, 6.0, 30, t, "r"),   # weekend gap: previous row
        ("S", D(2024, 1, 1), 1.0, 1.0, 1.0, 9.0, 7, t, "r"),    # single-row symbol
    ])
    out = by_key(staging.stg_stock_prices(raw), "symbol", "date")
    a1, a2, a5 = (out[("A", D(2024, 1, d))] for d in (1, 2, 5))
    assert a1["daily_return"] is None and a1["daily_volatility"] is None
    assert a2["daily_return"] is None                      # NULLIF(prev, 0)
    assert a5["daily_return"] == (6.0 - 5.0) / 5.0          # previous row, not previous day
    assert a5["volume_ma5"] == 20.0 and a2["volume_ma5"] == 15.0  # short frames
    s = out[("S", D(2024, 1, 1))]
    assert s["daily_return"] is None and s["volume_ma5"] == 7.0
    assert s["price_change"] == 8.0


def test_benchmark_changes_and_zero_value(spark):
    t = TS(2024, 1, 10)
    raw = bench(spark, [("^GSPC", D(2024, 1, 1), 0.0, t, "r"), ("^GSPC", D(2024, 1, 2), 4.0, t, "r"),
                        ("^GSPC", D(2024, 1, 5), 5.0, t, "r")])
    out = by_key(staging.stg_benchmark_series(raw), "date")
    assert out[(D(2024, 1, 2),)]["pct_change"] is None
    assert out[(D(2024, 1, 2),)]["daily_change"] == 4.0
    assert out[(D(2024, 1, 5),)]["pct_change"] == 0.25


def test_company_fallback_to_clean_snapshot(spark):
    raw = company(spark, [
        ("A", "A new", "Tech", 5, TS(2024, 1, 2), "r2", "boom"),   # newest has an error
        ("A", "A old", "Tech", 4, TS(2024, 1, 1), "r1", None),
        ("B", "B", "Fin", 1, TS(2024, 1, 2), "r2", "boom"),        # only error rows
        ("C", "C2", "Fin", 2, TS(2024, 1, 2), "r2", None),
        ("C", "C1", "Fin", 1, TS(2024, 1, 1), "r1", None),
    ])
    out = by_key(staging.stg_company_info(raw), "symbol")
    assert set(out) == {("A",), ("C",)}
    assert out[("A",)]["company_name"] == "A old"
    assert out[("C",)]["company_name"] == "C2"
    assert "source_run_id" not in staging.stg_company_info(raw).columns


def test_cap_category_boundaries(spark):
    caps = [None, 299_999_999, 300_000_000, 1_999_999_999, 2_000_000_000, 10_000_000_000,
            200_000_000_000]
    df = spark.createDataFrame([(c,) for c in caps], "cap bigint")
    got = [r[0] for r in df.select(cap_category("cap")).collect()]
    assert got == ["Micro Cap", "Micro Cap", "Small Cap", "Small Cap", "Mid Cap", "Large Cap",
                   "Mega Cap"]


def test_fact_missing_benchmark_and_company(spark):
    t = TS(2024, 1, 10)
    p = staging.stg_stock_prices(prices(spark, [
        ("A", D(2024, 1, 1), 1.0, 1.0, 1.0, 10.0, 1, t, "r"),
        ("A", D(2024, 1, 2), 1.0, 1.0, 1.0, 11.0, 1, t, "r"),
        ("Z", D(2024, 1, 2), 1.0, 1.0, 1.0, 11.0, 1, t, "r"),
    ]))
    c = staging.stg_company_info(company(spark, [("A", "A", "Tech", 3_000_000_000, t, "r", None)]))
    b = staging.stg_benchmark_series(bench(spark, [("^GSPC", D(2024, 1, 1), 100.0, t, "r"),
                                                   ("^GSPC", D(2024, 1, 3), 110.0, t, "r")]))
    fact = marts.fact_daily_metrics(p, c, b)
    assert fact.columns == marts.FACT_COLUMNS
    out = by_key(fact, "symbol", "date")
    a1, a2, z = out[("A", D(2024, 1, 1))], out[("A", D(2024, 1, 2))], out[("Z", D(2024, 1, 2))]
    assert a1["sp500_value"] == 100.0 and a1["alpha_vs_sp500"] == 0.0  # first day: -NULL -> 0
    assert a2["sp500_value"] is None                                    # no benchmark that day
    assert math.isclose(a2["alpha_vs_sp500"], 0.1)                       # = daily_return
    assert a1["market_cap_category"] == "Mid Cap"
    assert z["sector"] is None and z["market_cap_category"] == "Micro Cap"


def test_dim_columns(spark):
    t = TS(2024, 1, 10)
    c = staging.stg_company_info(company(spark, [("A", "A", "Tech", 1, t, "r", None)]))
    d = marts.dim_stocks(c)
    assert d.columns == marts.DIM_COLUMNS + ["last_updated"]
    assert d.first()["last_updated"] == t


def test_dedup_is_idempotent_and_fact_keeps_rows(spark):
    from conftest import SF_SMALL
    from marketlake.plans import catalog
    p = catalog.stg_prices(spark, SF_SMALL)
    again = staging.stg_stock_prices(p.select(*staging.PRICE_COLUMNS))
    cols = staging.PRICE_COLUMNS
    assert sorted(p.select(*cols).collect()) == sorted(again.select(*cols).collect())
    assert catalog.fact(spark, SF_SMALL).count() == p.count()
    assert p.filter(F.col("daily_return").isNull()).select("symbol").distinct().count() == \
        p.select("symbol").distinct().count()
