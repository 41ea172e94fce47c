"""Reshaping of downloads and company documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketlake.operators.filters import period_start, restrict, select_range
from marketlake.sources import documents as docs
from marketlake.sources import reshape

D = dt.date
BLOCK = ("struct<Open:double,High:double,Low:double,Close:double,`Adj Close`:double,"
         "Volume:bigint>")


def wide(spark):
    rows = [(D(2024, 1, 1), (1.0, 2.0, 0.5, 1.5, 1.4, 10), (5.0, 6.0, 4.0, 5.5, 5.5, None)),
            (D(2024, 1, 2), (1.5, 2.5, 1.0, float("nan"), 2.0, 11), None),
            (D(2024, 1, 3), (2.0, 3.0, 1.5, 2.5, 2.4, 12), (6.0, 7.0, 5.0, 6.5, 6.4, 3))]
    return spark.createDataFrame(rows, f"Date date, AAPL {BLOCK}, `BRK.B` {BLOCK}")


def test_prices_long_single_pass_drops_incomplete_and_missing(spark):
    out = reshape.prices_long(wide(spark), ["AAPL", "BRK.B", "GONE"])
    assert out.columns == reshape.PRICE_LONG_COLUMNS
    got = sorted((r.symbol, r.date.day, r.close, r.volume) for r in out.collect())
    # NaN close, NULL volume and the absent block are dropped; GONE is skipped
    assert got == [("AAPL", 1, 1.5, 10), ("AAPL", 3, 2.5, 12), ("BRK.B", 3, 6.5, 3)]
    assert out.filter("adj_close = 2.4").count() == 1


def test_prices_long_nothing_present_gives_empty_frame(spark):
    out = reshape.prices_long(wide(spark), ["NOPE"])
    assert out.count() == 0 and out.columns == reshape.PRICE_LONG_COLUMNS


def test_benchmark_long(spark):
    out = reshape.benchmark_long(wide(spark), ["AAPL", "BRK.B"])
    got = sorted((r.series_ticker, r.date.day, r.value) for r in out.collect())
    assert got == [("AAPL", 1, 1.5), ("AAPL", 3, 2.5), ("BRK.B", 1, 5.5), ("BRK.B", 3, 6.5)]


def test_single_ticker_and_normalisation(spark):
    flat = spark.createDataFrame([(D(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 1.4, 7)],
                                 "Date date, Open double, High double, Low double, Close double, "
                                 "`Adj Close` double, Volume bigint")
    out = reshape.prices_single(flat, "MSFT")
    assert out.columns == reshape.PRICE_LONG_COLUMNS
    assert out.first().symbol == "MSFT" and out.first().adj_close == 1.4


@pytest.mark.parametrize("cols,expected", [
    (["Date", "Open", "Close", "Adj Close"], ("Date", "Adj Close")),   # last close-like wins
    (["index", "close", "Datetime"], ("Datetime", "close")),           # last date-like wins
    (["a", "b"], None),
])
def test_resolve_series_columns(cols, expected):
    assert reshape.resolve_series_columns(cols) == expected


def test_benchmark_single_fallback_to_first_two_columns(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 3.0), (D(2024, 1, 2), None)], "d date, v double")
    out = reshape.benchmark_single(df, "^VIX").collect()
    assert [(r.series_ticker, r.value) for r in out] == [("^VIX", 3.0)]


def test_stamp_is_one_timestamp(spark):
    now = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = reshape.stamp(spark.range(3), now)
        assert {r.ingested_at for r in out.collect()} == {now}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dict(out.dtypes)["ingested_at"] == "timestamp_ntz"


def test_company_documents(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [("A", json.dumps({"longName": None, "shortName": "a", "marketCap": 5}), ts),
            ("B", json.dumps({"shortName": "b", "trailingPE": 1.5, "unknown": 1}), ts),
            ("C", json.dumps({"sector": "Tech"}), ts),
            ("D", '{"longName": "d"', ts),
            ("E", None, ts),
            ("F", json.dumps({"longName": "Foo Inc", "fullTimeEmployees": 12}), ts)]
    df = spark.createDataFrame(rows, "symbol string, doc string, ingested_at timestamp_ntz")
    out = {r.symbol: r for r in docs.company_from_json(df).collect()}
    assert out["A"].company_name is None and out["A"].market_cap == 5   # explicit null stays
    assert out["B"].company_name == "b" and out["B"].pe_ratio == 1.5    # absent -> shortName
    assert out["C"].company_name == "C" and out["C"].sector == "Tech"   # -> symbol
    assert out["D"].error == docs.MALFORMED and out["D"].company_name is None
    assert out["E"].error == docs.MISSING
    assert out["F"].employees == 12 and out["F"].error is None
    cols = docs.company_from_json(df).columns
    assert cols[:2] == ["symbol", "company_name"] and cols[-2:] == ["ingested_at", "error"]


def test_ragged_union(spark):
    good = spark.createDataFrame([("A", "x")], "symbol string, sector string")
    bad = spark.createDataFrame([("B", "err")], "symbol string, error string")
    out = sorted(tuple(r) for r in docs.company_records(good, bad).collect())
    assert out == [("A", "x", None), ("B", None, "err")]


def test_explode_messages(spark):
    df = spark.createDataFrame([(1, json.dumps([{"craft": "ISS", "name": "Ann"},
                                                {"craft": "T", "name": "Bo"}]))], "id int, l string")
    out = [r.message for r in docs.explode_messages(df, "l", keep=("id",)).orderBy("pos").collect()]
    assert out == ["Ann is currently in space flying on the ISS! Hello! :)",
                   "Bo is currently in space flying on the T! Hello! :)"]
    odd = spark.createDataFrame([(2, json.dumps([{"craft": "ISS"}]))], "id int, l string")
    assert docs.explode_messages(odd, "l").first().message == \
        "None is currently in space flying on the ISS! Hello! :)"


def test_select_range_and_periods(spark):
    df = spark.createDataFrame([(D(2023, 12, 31),), (D(2024, 1, 1),), (D(2024, 1, 25),),
                                (D(2024, 1, 30),), (D(2024, 1, 31),)], "date date")
    days = lambda out: sorted(r.date for r in out.collect())
    assert days(select_range(df, "2024-01-01", "2024-01-30")) == [D(2024, 1, 1), D(2024, 1, 25)]
    # a single bound is ignored: the period applies
    assert days(select_range(df, start="2024-01-25", period="5d", as_of="2024-01-30")) == \
        [D(2024, 1, 30)]
    # one month before 2024-01-30 is 2023-12-30 (exclusive)
    assert days(select_range(df, period="1mo", as_of="2024-01-30")) == \
        [D(2023, 12, 31), D(2024, 1, 1), D(2024, 1, 25), D(2024, 1, 30)]
    assert days(select_range(df, period="ytd", as_of="2024-01-30")) == \
        [D(2024, 1, 1), D(2024, 1, 25), D(2024, 1, 30)]
    assert len(days(select_range(df, period="max", as_of="2024-01-31"))) == 5
    with pytest.raises(ValueError):
        period_start("7w", "2024-01-01")
    with pytest.raises(ValueError):
        select_range(df, period="1y")


def test_restrict_list_and_frame(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "symbol string, v int")
    assert restrict(df, "symbol", ["A", "C"]).count() == 2
    uni = spark.createDataFrame([("B",), ("B",)], "s string")
    assert [r.symbol for r in restrict(df, "symbol", uni).collect()] == ["B"]


def test_numbers_in_documents(spark):
    ts = dt.datetime(2024, 1, 1)
    texts = {
        "float": '{"marketCap": 2500000000000.0, "fullTimeEmployees": 164000.0}',
        "exponent": '{"marketCap": 2.5e12, "beta": 1e0}', "text": '{"marketCap": "2500000000000"}',
        "bad": '{"marketCap": "n/a", "beta": "n/a", "trailingPE": 3, "sector": "T"}',
        "part": '{"fullTimeEmployees": 12.5}', "large": '{"marketCap": 9007199254740993}',
        "over": '{"marketCap": 1e30, "fullTimeEmployees": 3000000000}', "null": '{"marketCap": null}',
        "nan": '{"marketCap": NaN}', "list": "[1]", "nantext": '{"beta": "NaN"}',
    }
    df = spark.createDataFrame([(k, v, ts) for k, v in texts.items()],
                               "symbol string, doc string, ingested_at timestamp_ntz")
    out = {r.symbol: r for r in docs.company_from_json(df).collect()}
    for k in ("float", "exponent", "text"):
        assert (out[k].market_cap, out[k].error) == (2_500_000_000_000, None), k
    assert out["float"].employees == 164000 and out["exponent"].beta == 1.0
    assert out["bad"].error == docs.UNREADABLE + "marketCap, beta"
    assert (out["bad"].market_cap, out["bad"].pe_ratio, out["bad"].sector) == (None, 3.0, "T")
    assert out["part"].error == docs.UNREADABLE + "fullTimeEmployees"
    assert out["large"].market_cap == 9007199254740993
    assert out["over"].error == docs.UNREADABLE + "marketCap, fullTimeEmployees"
    assert out["null"].error is None and out["null"].market_cap is None
    assert out["nan"].error == out["list"].error == docs.MALFORMED
    assert out["nantext"].error == docs.UNREADABLE + "beta"


def test_latest_date_of_empty_frame_is_null(spark):
    from marketlake.operators.aggregates import latest_date
    df = spark.createDataFrame([(D(2024, 1, 3),), (D(2024, 1, 9),)], "date date")
    assert latest_date(df).first().latest_date == D(2024, 1, 9)
    assert latest_date(df.limit(0)).first().latest_date is None     # one row, NULL


def test_thousands_of_tickers_are_planned_in_seconds(spark):
    import time
    n = 5000
    one = F.struct(*[F.lit(1.5).alias(f) for f in reshape.WIDE_FIELDS[:5]], F.lit(3).cast("long").alias("Volume"))
    wide = spark.range(2).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("Date"),
                                 *[one.alias(f"T{i}") for i in range(n)])
    tickers = [f"T{i}" for i in range(n)] + ["delisted"]
    began = time.time()
    long, bench = reshape.prices_long(wide, tickers), reshape.benchmark_long(wide, tickers)
    assert time.time() - began < 30  # about 2 s; a struct of fields per ticker took 20 s
    assert long.count() == 2 * n and long.select("symbol").distinct().count() == n
    assert bench.count() == 2 * n


def test_names_and_types_of_blocks(spark):
    fields = ", ".join(f"`{f}` double" for f in reshape.WIDE_FIELDS[:5])
    odd = "it's `a`.b\\c"
    wide = spark.createDataFrame(
        [(dt.date(2024, 1, 1), (1.0, 2.0, 3.0, 4.0, 5.0, 6), (1.0, 2.0, 3.0, 4.0, 5.0, 6.0), None)],
        f"Date date, `{odd.replace('`', '``')}` struct<{fields.replace('` ', '`: ')}, Volume: bigint>, "
        f"B struct<{fields.replace('` ', '`: ')}, Volume: double>, C struct<{fields.replace('` ', '`: ')}, Volume: bigint>")
    rows = {r.symbol: (r.close, r.volume) for r in reshape.prices_long(wide, [odd, "B", "C"]).collect()}
    assert rows == {odd: (4.0, 6), "B": (4.0, 6)}
    bench = {r.series_ticker: r.value for r in reshape.benchmark_long(wide, [odd, "B", "C"]).collect()}
    assert bench == {odd: 4.0, "B": 4.0}
