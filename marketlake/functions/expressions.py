"""Scalar expressions used by the models and the dashboard queries.

All return ``Column`` objects built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen. Spark 4 runs with ANSI on: an unguarded ``x / 0`` raises, so every
ratio goes through ``safe_div`` (a ``NULLIF`` guard, as in the reference SQL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "safe_div", "pct_change_of", "alpha", "cap_category", "days_before", "age_days",
    "parse_date", "round_even", "pct_label", "pct_fixed", "thousands",
    "stock_label", "date_value", "CAP_BANDS", "MICRO_CAP",
]

# Market-cap bands, checked in this order (inclusive lower bounds, USD).
CAP_BANDS = [
    (200_000_000_000, "Mega Cap"),
    (10_000_000_000, "Large Cap"),
    (2_000_000_000, "Mid Cap"),
    (300_000_000, "Small Cap"),
]
MICRO_CAP = "Micro Cap"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: a zero denominator gives NULL instead of an error."""
    return col_(num) / F.nullif(col_(den), F.lit(0))


def pct_change_of(cur, prev) -> Column:
    """``(cur - prev) / NULLIF(prev, 0)``."""
    return safe_div(col_(cur) - col_(prev), prev)


def alpha(ret, bench_ret) -> Column:
    """Excess return; a missing side counts as 0, so the result is never NULL."""
    return F.coalesce(col_(ret), F.lit(0.0)) - F.coalesce(col_(bench_ret), F.lit(0.0))


def cap_category(cap) -> Column:
    """Band of a market cap; NULL (unknown company) falls through to Micro Cap."""
    c = col_(cap)
    expr = None
    for lower, label in CAP_BANDS:
        cond = c >= F.lit(lower)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(MICRO_CAP)


def days_before(as_of, n: int) -> Column:
    """``DATEADD(day, -n, as_of)`` as a DATE."""
    return F.date_sub(date_value(as_of), n)


def age_days(as_of, d) -> Column:
    """Whole days between ``d`` and ``as_of``."""
    return F.datediff(date_value(as_of), col_(d))


def parse_date(s) -> Column:
    return F.to_date(col_(s), "yyyy-MM-dd")


def round_even(x, digits: int = 2) -> Column:
    """numpy-style rounding: ``rint(x * 10^d) / 10^d`` (half to even on the scaled binary value).

    Spark's ``round`` is HALF_UP, which differs on ties such as 0.125.
    """
    scale = float(10 ** digits)
    return F.rint(col_(x) * F.lit(scale)) / F.lit(scale)


def _signed(x, magnitude: Column) -> Column:
    """``magnitude`` with a minus sign for negative values and negative zero."""
    c = col_(x)
    minus = (c < 0) | ((c == 0) & c.cast("string").startswith("-"))
    return F.concat(F.when(minus, "-").otherwise(""), magnitude)


def _hundredths(n: Column) -> Column:
    """A whole number of hundredths with two decimals."""
    whole = F.floor(n / F.lit(100.0)).cast("bigint")
    return F.concat(whole.cast("string"), F.lit("."),
                    F.lpad((n.cast("bigint") - whole * 100).cast("string"), 2, "0"))


def _special(x: Column, text: Column) -> Column:
    """``nan`` and ``inf`` as Python prints them; NULL is a missing number, so ``nan``."""
    return (F.when(x.isNull() | F.isnan(x), F.lit("nan"))
            .when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
            .otherwise(text))


def pct_label(x) -> Column:
    """``str(round(x * 100, 2)) + '%'`` as numpy rounds and Python prints it.

    Java turns to scientific notation at 1e7 and Python at 1e16; between them the decimal
    digits are written out.
    """
    y = round_even(col_(x) * F.lit(100.0), 2)
    size = F.abs(y)
    plain = F.regexp_replace(size.cast("decimal(38,2)").cast("string"), r"(\.\d)0$", "$1")
    science = F.regexp_replace(F.regexp_replace(size.cast("string"), r"\.0E", "E"), "E", "e+")
    return F.concat(_special(y, F.when(size < 1e7, y.cast("string")).otherwise(
        _signed(y, F.when(size < 1e16, plain).otherwise(science)))), F.lit("%"))


def pct_fixed(x) -> Column:
    """``f"{x * 100:.2f}%"``: two decimals of the exact binary value, ties to even.

    The product with 100 is taken without rounding error (Dekker's splitting), so a value
    next to a tie falls to the right side. Exact below 2^53 hundredths; greater values are
    whole numbers.
    """
    y = F.abs(col_(x) * F.lit(100.0))
    p = y * F.lit(100.0)
    big = y * F.lit(134217729.0)
    high = big - (big - y)
    error = (high * F.lit(100.0) - p) + (y - high) * F.lit(100.0)
    low = F.floor(p).cast("double")
    part = p - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (low % 2 == 1))))
    small = _hundredths(low + F.when(up, 1.0).otherwise(0.0))
    large = F.concat(y.cast("decimal(38,0)").cast("string"), F.lit(".00"))
    y0 = col_(x) * F.lit(100.0)
    return F.concat(_special(y0, _signed(y0, F.when(p < 2.0 ** 53, small).otherwise(large))),
                    F.lit("%"))


def thousands(n) -> Column:
    """Integer with thousands separators, e.g. 1,234,567."""
    return F.format_number(col_(n), 0)


def stock_label(symbol, name) -> Column:
    """``"{symbol} - {company_name}"``; a missing name prints as None."""
    return F.concat(col_(symbol).cast("string"), F.lit(" - "),
                    F.coalesce(col_(name).cast("string"), F.lit("None")))


def date_value(d) -> Column:
    """A date given as a Column, a ``datetime.date`` or an ISO string, as a DATE Column."""
    if isinstance(d, Column):
        return d
    return F.to_date(F.lit(str(d)))
