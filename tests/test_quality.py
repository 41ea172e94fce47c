"""Data-quality checks Q1-Q5 on edge frames."""

import datetime as dt

import pytest

from marketlake.operators import quality as q

D = dt.date


def frame(spark):
    return spark.createDataFrame(
        [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 1), 2.0), (None, D(2024, 1, 2), None),
         ("B", None, 3.0)], "symbol string, date date, close double")


def test_not_null_counts_every_column_in_one_pass(spark):
    out = {r.column_name: r for r in q.check_not_null(frame(spark), ["symbol", "date", "close"],
                                                      "t").collect()}
    assert {k: v.observed for k, v in out.items()} == {"symbol": 1, "date": 1, "close": 1}
    assert all(v.status == "fail" for v in out.values())


def test_unique_ignores_nulls_and_combination_does_not(spark):
    u = q.check_unique(frame(spark), "symbol", "t").first()
    assert (u.observed, u.status) == (1, "fail")
    c = q.check_unique_combination(frame(spark), ["symbol", "date"], "t").first()
    assert (c.observed, c.status, c.column_name) == (1, "fail", "symbol,date")
    ok = q.check_unique(spark.createDataFrame([(None,), (None,)], "symbol string"), "symbol", "t")
    assert ok.first().status == "pass"


def test_non_empty(spark):
    empty = frame(spark).limit(0)
    assert q.check_non_empty(empty, "t").first().status == "fail"
    assert q.check_non_empty(frame(spark), "t").first().observed == 4
    with pytest.raises(q.DataQualityError):
        q.assert_non_empty(empty, "t")
    q.assert_non_empty(frame(spark), "t")


@pytest.mark.parametrize("as_of,status,age", [("2024-01-09", "pass", 7),
                                              ("2024-01-10", "warn", 8)])
def test_freshness_warns_after_seven_days(spark, as_of, status, age):
    r = q.check_freshness(frame(spark), "t", as_of).first()
    assert (r.observed, r.status) == (age, status)


def test_freshness_of_empty_table_fails(spark):
    assert q.check_freshness(frame(spark).limit(0), "t", "2024-01-01").first().status == "fail"


def test_orphans(spark):
    fact = spark.createDataFrame([("A",), ("Z",), ("Z",)], "symbol string")
    dim = spark.createDataFrame([("A",)], "symbol string")
    r = q.orphan_rows(fact, dim).first()
    assert (r.observed, r.status) == (2, "warn")


@pytest.mark.parametrize("kw", [dict(unique="symbol"), dict(unique_combination=["symbol", "date"]),
                                dict()])
def test_one_pass_model_checks_equal_single_checks(spark, kw):
    df = frame(spark)
    one = q.check_model(df, "t", not_null=["symbol", "close"], non_empty=True,
                        freshness="date", as_of="2024-01-10", **kw)
    singles = [q.check_not_null(df, ["symbol", "close"], "t"), q.check_non_empty(df, "t"),
               q.check_freshness(df, "t", "2024-01-10")]
    if "unique" in kw:
        singles.append(q.check_unique(df, "symbol", "t"))
    if "unique_combination" in kw:
        singles.append(q.check_unique_combination(df, ["symbol", "date"], "t"))
    assert sorted(one.collect()) == sorted(q.union_checks(singles).collect())
    empty = q.check_model(df.limit(0), "t", not_null=["close"], non_empty=True, **kw)
    got = {r.check_name: (r.observed, r.status) for r in empty.collect()}
    assert got["non_empty"] == (0, "fail") and got["not_null"] == (0, "pass")
