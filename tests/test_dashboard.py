"""Dashboard windows, statistics and formatting."""

import datetime as dt
import os

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketlake.functions import expressions as E
from marketlake.plans import dashboard as dash
from marketlake.plans.catalog import QUERIES
from marketlake.plans.oracle import ORACLE

D = dt.date


def fact(spark, rows):
    """rows: (symbol, date, close, daily_return, sp500_value, sp500_return, alpha, vix)."""
    return spark.createDataFrame(rows, "symbol string, date date, close double, "
                                       "daily_return double, sp500_value double, "
                                       "sp500_return double, alpha_vs_sp500 double, "
                                       "vix_value double")


def test_benchmark_comparison_windows(spark):
    rows = [("A", D(2024, 1, d), c, r, s, sr, 0.0, 10.0)
            for d, c, r, s, sr in [(1, 100.0, None, 50.0, None), (2, 110.0, 0.1, 55.0, 0.1),
                                   (3, 99.0, -0.1, 55.0, 0.0), (4, 99.0, 0.0, None, None)]]
    rows.append(("N", D(2024, 1, 1), None, None, 10.0, None, 0.0, 1.0))   # NULL first close
    rows.append(("N", D(2024, 1, 2), 5.0, None, 20.0, 1.0, 0.0, 1.0))
    out = {(r.symbol, r.date.day): r for r in dash.benchmark_comparison(fact(spark, rows), 3).collect()}
    assert set(out) == {("A", 2), ("A", 3), ("A", 4), ("N", 1), ("N", 2)}  # latest 3 rows
    assert out[("A", 2)].stock_index == 100.0 and out[("A", 3)].stock_index == 90.0
    assert out[("A", 4)].sp500_index is None
    # cumulative return includes the first displayed row's own return
    assert out[("A", 2)].cum_return == (1 + 0.1) - 1          # as pandas cumprod gives
    assert out[("A", 3)].cum_return == (1 + 0.1) * (1 - 0.1) - 1
    assert out[("N", 2)].stock_index is None          # first value NULL -> NULL index
    assert out[("N", 1)].cum_return == 0.0            # fillna(0)


def test_one_symbol_variant_is_a_limit(spark):
    rows = [("A", D(2024, 1, d), float(d), 0.0, 1.0, 0.0, 0.0, 1.0) for d in range(1, 11)]
    rows += [("B", D(2024, 1, d), float(d), 0.0, 1.0, 0.0, 0.0, 1.0) for d in range(1, 11)]
    one = dash.benchmark_comparison(fact(spark, rows), 7, symbol="A")
    got = one.collect()
    assert len(got) == 7 and {r.symbol for r in got} == {"A"}
    assert min(r.date.day for r in got) == 4
    assert "TakeOrderedAndProject" in one._jdf.queryExecution().executedPlan().toString()


def test_performance_stats_single_row_and_nulls(spark):
    rows = [("A", D(2024, 1, 1), 1.0, 0.1, 1.0, 0.0, 0.1, 1.0),
            ("A", D(2024, 1, 2), 1.0, None, 1.0, 0.0, 0.0, 1.0),
            ("A", D(2024, 1, 3), 1.0, 0.3, 1.0, 0.0, 0.3, 1.0),
            ("S", D(2024, 1, 1), 1.0, 0.5, 1.0, 0.0, 0.5, 1.0)]
    out = {r.symbol: r for r in dash.performance_stats(fact(spark, rows), 30).collect()}
    assert out["A"].avg_daily_return == 0.2 and out["A"].n_rows == 3
    assert abs(out["A"].volatility - 0.141421) < 1e-6
    assert out["S"].volatility is None                 # n = 1 -> NULL (pandas: NaN)


def test_formatting(spark):
    df = spark.createDataFrame([(0.00125, 1234567, "AAPL", None), (None, 0, "X", "Name")],
                               "x double, n bigint, s string, name string")
    r = df.select(E.round_even(F.lit(0.125), 2).alias("half_even"),
                  E.round_even(F.lit(0.135), 2).alias("b"),
                  E.pct_label("x").alias("pl"), E.pct_fixed("x").alias("pf"),
                  E.thousands("n").alias("th"), E.stock_label("s", "name").alias("lab")).collect()
    assert r[0].half_even == 0.12                      # numpy: 0.12; Spark round: 0.13
    assert r[0].pl == r[0].pf == "0.12%"
    assert r[0].th == "1,234,567" and r[0].lab == "AAPL - None"
    assert r[1].pl == r[1].pf == "nan%" and r[1].lab == "X - Name"


def test_home_kpis_and_labels(spark):
    f = fact(spark, [("A", D(2024, 1, 1), 1.0, None, None, None, 0.0, None),
                     ("A", D(2024, 1, 2), 1.0, None, None, None, 0.0, None)])
    dim = spark.createDataFrame([("A",), ("B",)], "symbol string")
    k = dash.home_kpis(dim, f).first()
    assert (k.total_stocks, k.latest_date, k.total_records) == (2, D(2024, 1, 2), 2)
    empty = f.filter(F.lit(False))
    lab = dash.home_kpi_labels(dash.home_kpis(dim, empty)).first()
    assert lab.latest_data == "N/A" and lab.total_records == "0"


def test_screener_filters_and_display(spark):
    summary = spark.createDataFrame(
        [("A", "a", "Tech", "x", "Mega Cap", D(2024, 1, 2), 10.005, 0.001234, None),
         ("B", "b", "Fin", "y", "Micro Cap", None, None, None, None)],
        "symbol string, company_name string, sector string, industry string, "
        "market_cap_category string, latest_date date, avg_close double, avg_return double, "
        "avg_alpha double")
    from marketlake.operators.filters import screen
    assert screen(summary).count() == 2
    assert screen(summary, sector="Tech").count() == 1
    assert screen(summary, cap="Micro Cap").count() == 1
    assert screen(summary, sector="Fin", symbol="A").count() == 0
    disp = {r.symbol: r for r in dash.screener_display(summary).collect()}
    assert disp["A"].avg_return == "0.12%" and disp["B"].avg_alpha == "nan%"
    assert dash.screener_count(screen(summary, sector="Tech")).first().n_stocks == 1


def test_scalar_helpers(spark):
    import datetime as dt2
    df = spark.createDataFrame([("2024-01-31", dt2.datetime(2024, 1, 31, 23, 59), None, 0.5, 4.0)],
                               "s string, ts timestamp_ntz, n double, x double, p double")
    r = df.select(E.parse_date("s").alias("d"),
                  E.days_before("2024-01-31", 30).alias("before"),
                  E.age_days("2024-02-08", E.parse_date("s")).alias("age"),
                  E.pct_change_of("x", "p").alias("chg"),
                  E.pct_change_of("x", "n").alias("chg_null"),
                  E.safe_div("x", F.lit(0.0)).alias("div0")).first()
    assert r.d == D(2024, 1, 31)
    assert r.before == D(2024, 1, 1) and r.age == 8
    assert r.chg == (0.5 - 4.0) / 4.0 and r.chg_null is None and r.div0 is None


def test_top_n(spark):
    from marketlake.operators.topk import top_n
    df = spark.createDataFrame([(i, 10 - i) for i in range(10)], "a int, b int")
    assert [r.a for r in top_n(df, 2, F.col("a").desc()).collect()] == [9, 8]


def test_price_trend_window_is_inclusive_and_semi_joined(spark):
    f = fact(spark, [("A", D(2024, 1, 31), 1.0, None, None, None, 0.0, None),
                     ("A", D(2024, 1, 1), 2.0, None, None, None, 0.0, None),    # as_of - 30
                     ("A", D(2023, 12, 31), 3.0, None, None, None, 0.0, None),  # as_of - 31
                     ("B", D(2024, 1, 31), 4.0, None, None, None, 0.0, None)])
    shown = spark.createDataFrame([("A",)], "symbol string")
    out = dash.price_trend(f, shown, "2024-01-31", 30).collect()
    assert [(r.symbol, r.date) for r in out] == [("A", D(2024, 1, 31)), ("A", D(2024, 1, 1))]
    latest = dash.price_trend(f, shown).collect()      # as_of defaults to the newest date
    assert len(latest) == 2


def test_price_trend_shows_rows_without_a_symbol_only_when_asked(spark):
    f = fact(spark, [(s, D(2024, 1, 31), 1.0, None, None, None, 0.0, None) for s in ("A", "B", None)])
    for shown, nulls, want in ((["A", None], True, {"A", None}), (["A", None], False, {"A"}),
                               (["A"], True, {"A"}), ([None], True, {None})):
        keys = spark.createDataFrame([(s,) for s in shown], "symbol string")
        out = dash.price_trend(f, keys, nulls=nulls)
        assert out.columns == ["symbol", "date", "close", "daily_return"]
        assert {r.symbol for r in out.collect()} == want, (shown, nulls)


def test_long_trend_shows_every_symbol(spark, tmp_dir):
    """All brands, whatever their name, in the trailing 30 days of the long history; none is left out."""
    for t in ("lineitem", "events"):
        os.symlink(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'brand#1'
                      WHEN 2 THEN '' ELSE p_brand END AS p_brand)
                    FROM read_parquet('{SF_SMALL}/part.parquet')) TO '{tmp_dir}/part.parquet'""")
    for d in (SF_SMALL, tmp_dir):
        lines = f"read_parquet('{d}/lineitem.parquet') JOIN read_parquet('{d}/part.parquet') ON l_partkey = p_partkey"
        want = con.execute(f"""SELECT DISTINCT p_brand, CAST(l_shipdate AS DATE) + 8112 FROM {lines}
            WHERE CAST(l_shipdate AS DATE) >= (SELECT max(CAST(l_shipdate AS DATE)) FROM {lines}) - 30""").fetchall()
        rows = QUERIES["price_trend_long_history"](spark, d).collect()
        assert len(rows) == len(want) and {(r.symbol, r.date) for r in rows} == set(want)
        assert any(not (s or "").startswith("Brand#1") for s, _ in want)
        for t in ("lineitem", "events", "part"):
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
        con.execute(f"CREATE OR REPLACE VIEW customer AS SELECT * FROM read_parquet('{SF_SMALL}/customer.parquet')")
        con.execute(f"CREATE OR REPLACE VIEW nation AS SELECT * FROM read_parquet('{SF_SMALL}/nation.parquet')")
        sql = {(s, day): (c, r) for s, day, c, r in con.execute(ORACLE["price_trend_long_history"]).fetchall()}
        assert sql == {(r.symbol, r.date): (r.close, r.daily_return) for r in rows}


def test_percent_texts_equal_python(spark):
    import math
    import random

    import numpy as np
    rng = random.Random(3)
    values = [0.0, -0.0, 0.01005, 0.02675, 0.00125, 0.00135, -0.00125, 1e-9, -1e-9, 1.0, 9.99995, 1e6,
              123456.789, 1e11, float("nan"), float("inf"), float("-inf"), None, 0.5, 12345.678912]
    values += [rng.uniform(-0.2, 0.2) for _ in range(3000)]
    values += [rng.randrange(-10**6, 10**6) / 10**k for k in (2, 3, 4, 5, 6) for _ in range(300)]
    values += [rng.randrange(-4000, 4000) * 2.0 ** -rng.randrange(4, 16) for _ in range(1000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(1, 9) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = df.select("x", E.pct_fixed("x").alias("fixed"), E.pct_label("x").alias("label")).collect()
    for r in got:
        x = float("nan") if r.x is None else r.x
        assert r.fixed == f"{x * 100:.2f}%", x
        want = float(np.round(x * 100, 2)) if not math.isnan(x) else x
        assert r.label == f"{want}%", x
