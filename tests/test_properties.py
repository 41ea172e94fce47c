"""Property tests against brute-force Python oracles on small random frames."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketlake.operators.dedup import latest_version
from marketlake.operators.windows import cumulative_return, entity_window
from marketlake.schemas import WATERMARKS
from marketlake.sinks.raw_store import upsert_watermark

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.datetime(2024, 1, 1)

rows_st = st.lists(st.tuples(st.sampled_from("ABC"), st.integers(1, 4), st.integers(0, 5),
                             st.integers(0, 3), st.floats(-5, 5, allow_nan=False)),
                   min_size=0, max_size=30)


def _frame(spark, rows):
    data = [(s, dt.date(2024, 1, d), BASE + dt.timedelta(hours=h), f"run_{r}", v)
            for s, d, h, r, v in rows]
    return spark.createDataFrame(data, "symbol string, date date, ingested_at timestamp_ntz, "
                                       "source_run_id string, v double")


@SETTINGS
@given(rows=rows_st)
def test_latest_version_matches_brute_force(spark, rows):
    df = _frame(spark, rows)
    got = latest_version(df, ["symbol", "date"], "ingested_at", ["source_run_id"])
    best = {}
    for s, d, h, r, v in rows:
        key, rank = (s, d), (h, f"run_{r}")
        if key not in best or rank > best[key][0]:
            best[key] = (rank, v)
    # ties on (ingest time, run id) may keep either row; compare the ranks then
    out = {(r.symbol, r.date.day): ((r.ingested_at - BASE).seconds // 3600, r.source_run_id)
           for r in got.collect()}
    assert out == {k: v[0] for k, v in best.items()}
    again = latest_version(got, ["symbol", "date"], "ingested_at", ["source_run_id"])
    assert sorted(again.collect()) == sorted(got.collect())


@SETTINGS
@given(n=st.integers(1, 12))
def test_cumulative_return_of_zero_returns_is_zero(spark, n):
    df = spark.createDataFrame([("A", dt.date(2024, 1, i + 1), None if i % 3 == 0 else 0.0)
                                for i in range(n)], "symbol string, date date, r double")
    out = df.select(cumulative_return("r", entity_window(["symbol"])).alias("c")).collect()
    assert all(row.c == 0.0 for row in out)


wm_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(1, 28)),
                 max_size=4, unique_by=lambda t: t[0])


@SETTINGS
@given(cur=wm_st, upd=wm_st)
def test_upsert_matches_dict_merge_and_is_idempotent(spark, cur, upd):
    mk = lambda rows: spark.createDataFrame(
        [(k, f"2024-01-{d:02d}", BASE) for k, d in rows], WATERMARKS)
    once = upsert_watermark(mk(cur), mk(upd))
    expected = {k: f"2024-01-{d:02d}" for k, d in cur}
    expected.update({k: f"2024-01-{d:02d}" for k, d in upd})
    assert {r.dataset_name: r.watermark_value for r in once.collect()} == expected
    twice = upsert_watermark(once, mk(upd))
    assert sorted(twice.collect()) == sorted(once.collect())


name_st = st.one_of(st.none(), st.just("<absent>"), st.text(min_size=0, max_size=5))


@SETTINGS
@given(docs=st.lists(st.tuples(name_st, name_st, st.booleans()), min_size=1, max_size=12))
def test_company_name_fallback_matches_dict_get(spark, docs):
    import json

    from marketlake.sources.documents import MALFORMED, company_from_json
    rows, expected = [], {}
    for i, (long_name, short_name, broken) in enumerate(docs):
        info = {}
        if long_name != "<absent>":
            info["longName"] = long_name
        if short_name != "<absent>":
            info["shortName"] = short_name
        sym = f"S{i}"
        text = json.dumps(info)
        if broken:
            text = text[:-1]            # drop the closing brace: malformed
            expected[sym] = (None, MALFORMED)
        else:
            expected[sym] = (info.get("longName", info.get("shortName", sym)), None)
        rows.append((sym, text, BASE))
    df = spark.createDataFrame(rows, "symbol string, doc string, ingested_at timestamp_ntz")
    got = {r.symbol: (r.company_name, r.error) for r in company_from_json(df).collect()}
    assert got == expected


raw_price_st = st.lists(st.tuples(
    st.sampled_from("AB"), st.integers(1, 8), st.integers(0, 3), st.integers(0, 2),
    st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 4.0, 10.0])),
    st.one_of(st.none(), st.integers(0, 50))), min_size=1, max_size=40)


@SETTINGS
@given(rows=raw_price_st)
def test_stg_stock_prices_matches_brute_force(spark, rows):
    from pyspark.sql import types as T

    from marketlake.plans.staging import stg_stock_prices
    from marketlake.schemas import STOCK_PRICES_DAILY

    data = [(s, dt.date(2024, 1, d), c, c, c, c, c, v, BASE + dt.timedelta(hours=h), f"run_{r}")
            for s, d, h, r, c, v in rows]
    # parquet raw tables do not enforce NOT NULL, so the frame is built without it too
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in STOCK_PRICES_DAILY])
    got = {(r.symbol, r.date.day): r for r in
           stg_stock_prices(spark.createDataFrame(data, schema)).collect()}

    latest = {}
    for s, d, h, r, c, v in rows:                       # newest ingest, then larger run id
        key, rank = (s, d), (h, f"run_{r}")
        if key not in latest or rank > latest[key][0]:
            latest[key] = (rank, c, v)
    for sym in {k[0] for k in latest}:
        days = sorted(d for s, d in latest if s == sym)
        for i, d in enumerate(days):
            _, close, vol = latest[(sym, d)]
            prev = latest[(sym, days[i - 1])][1] if i else None
            ret = None if close is None or prev in (None, 0.0) else (close - prev) / prev
            window = [latest[(sym, x)][2] for x in days[max(0, i - 4): i + 1]]
            vols = [x for x in window if x is not None]
            ma5 = sum(vols) / len(vols) if vols else None
            r = got[(sym, d)]
            assert r.close == close and r.daily_return == ret and r.volume_ma5 == ma5
            assert r.daily_volatility == (None if close in (None, 0.0) else 0.0)
    assert len(got) == len(latest)


fact_rows_st = st.lists(st.tuples(
    st.sampled_from("AB"), st.integers(1, 12),
    st.one_of(st.none(), st.sampled_from([0.0, 1.5, 2.0, 3.25, 7.0])),
    st.one_of(st.none(), st.sampled_from([-0.5, -0.1, 0.0, 0.05, 0.3]))),
    min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(rows=fact_rows_st, n=st.integers(1, 8))
def test_benchmark_comparison_matches_pandas(spark, rows, n):
    import math

    import pandas as pd

    from marketlake.plans.dashboard import benchmark_comparison
    data = [(s, dt.date(2024, 1, d), c, r, c, r, 0.0, 1.0) for s, d, c, r in rows]
    fact = spark.createDataFrame(data, "symbol string, date date, close double, daily_return "
                                       "double, sp500_value double, sp500_return double, "
                                       "alpha_vs_sp500 double, vix_value double")
    got = {(r.symbol, r.date): r for r in benchmark_comparison(fact, n).collect()}

    def clean(x):  # NULL here where pandas divides by zero
        return None if x is None or (isinstance(x, float) and (math.isnan(x) or math.isinf(x))) else x

    pdf = pd.DataFrame(data, columns=["symbol", "date", "close", "daily_return", "sp500_value",
                                      "sp500_return", "alpha", "vix"])
    expected = 0
    for sym, g in pdf.groupby("symbol"):
        d = g.sort_values("date", ascending=False).head(n).sort_values("date")
        first = d["close"].iloc[0]
        idx = [None if pd.isna(first) or first == 0 else x / first * 100 for x in d["close"]]
        cum = ((1 + d["daily_return"].fillna(0)).cumprod() - 1).tolist()
        for (_, row), i, c in zip(d.iterrows(), idx, cum):
            r = got[(sym, row["date"])]
            assert clean(r.stock_index) == clean(None if pd.isna(i) else i)
            assert r.cum_return == c
            expected += 1
    assert len(got) == expected


@SETTINGS
@given(rows=fact_rows_st, n=st.integers(1, 8))
def test_performance_stats_match_pandas(spark, rows, n):
    import pandas as pd

    from marketlake.plans.dashboard import performance_stats
    data = [(s, dt.date(2024, 1, d), c, r, c, r, (r or 0.0) - 0.01, 1.0) for s, d, c, r in rows]
    fact = spark.createDataFrame(data, "symbol string, date date, close double, daily_return "
                                       "double, sp500_value double, sp500_return double, "
                                       "alpha_vs_sp500 double, vix_value double")
    got = {r.symbol: r for r in performance_stats(fact, n).collect()}
    pdf = pd.DataFrame(data, columns=["symbol", "date", "close", "daily_return", "sp500_value",
                                      "sp500_return", "alpha", "vix"])
    for sym, g in pdf.groupby("symbol"):
        d = g.sort_values("date", ascending=False).head(n)
        for ours, theirs in ((got[sym].avg_daily_return, d["daily_return"].mean()),
                             (got[sym].avg_alpha, d["alpha"].mean()),
                             (got[sym].volatility, d["daily_return"].std())):
            if pd.isna(theirs):
                assert ours is None
            else:
                assert abs(ours - theirs) <= 5e-7


@SETTINGS
@given(prices=st.lists(st.tuples(st.sampled_from("ABC"), st.integers(1, 6),
                                 st.sampled_from([1.0, 2.0, 4.0, 5.0])),
                       min_size=1, max_size=15, unique_by=lambda t: (t[0], t[1])),
       caps=st.dictionaries(st.sampled_from("AB"), st.one_of(
           st.none(), st.sampled_from([299_999_999, 300_000_000, 2_000_000_000,
                                       10_000_000_000, 200_000_000_000]))),
       gspc=st.dictionaries(st.integers(1, 6), st.sampled_from([0.0, 100.0, 110.0, 99.0])))
def test_fact_matches_brute_force(spark, prices, caps, gspc):
    from pyspark.sql import types as T

    from marketlake.functions.expressions import CAP_BANDS, MICRO_CAP
    from marketlake.plans import marts, staging
    from marketlake.schemas import BENCHMARK_SERIES_DAILY, COMPANY_INFO, STOCK_PRICES_DAILY

    def nullable(schema):
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])

    p = spark.createDataFrame([(s, dt.date(2024, 1, d), c, c, c, c, c, 1, BASE, "r")
                               for s, d, c in prices], nullable(STOCK_PRICES_DAILY))
    width = len(COMPANY_INFO.fields)
    comp = []
    for sym, cap in caps.items():
        row = [None] * width
        row[0], row[2], row[4], row[-3], row[-2] = sym, f"sector-{sym}", cap, BASE, "r"
        comp.append(tuple(row))
    c = spark.createDataFrame(comp, nullable(COMPANY_INFO))
    b = spark.createDataFrame([("^GSPC", dt.date(2024, 1, d), v, BASE, "r")
                               for d, v in gspc.items()], nullable(BENCHMARK_SERIES_DAILY))
    fact = marts.fact_daily_metrics(staging.stg_stock_prices(p), staging.stg_company_info(c),
                                    staging.stg_benchmark_series(b))
    got = {(r.symbol, r.date.day): r for r in fact.collect()}

    bench_days = sorted(gspc)
    bench_ret = {d: (None if i == 0 or gspc[bench_days[i - 1]] == 0.0
                     else (gspc[d] - gspc[bench_days[i - 1]]) / gspc[bench_days[i - 1]])
                 for i, d in enumerate(bench_days)}
    closes = {(s, d): v for s, d, v in prices}
    assert len(got) == len(closes)
    for (s, d), close in closes.items():
        days = sorted(x for (y, x) in closes if y == s)
        i = days.index(d)
        prev = closes[(s, days[i - 1])] if i else None
        ret = None if prev is None else (close - prev) / prev
        cap = caps.get(s)
        band = next((label for lower, label in CAP_BANDS if cap is not None and cap >= lower),
                    MICRO_CAP)
        r = got[(s, d)]
        assert r.daily_return == ret and r.market_cap == cap and r.market_cap_category == band
        assert r.sector == (f"sector-{s}" if s in caps else None)
        assert r.sp500_value == gspc.get(d) and r.sp500_return == bench_ret.get(d)
        assert r.alpha_vs_sp500 == (ret or 0.0) - (bench_ret.get(d) or 0.0)
