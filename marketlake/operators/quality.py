"""Data-quality checks Q1-Q5 as result tables.

Each check yields rows ``(check_name, object_name, column_name, observed, status)``:
* not_null - observed = NULL count; all columns of a table in one aggregate pass
* unique / unique_combination - observed = number of duplicated key values (groups)
* non_empty - observed = row count; an empty table fails (hard failure)
* freshness - observed = days between the newest date and ``as_of``; older than the
  limit only warns
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.expressions import date_value

FRESHNESS_DAYS = 7

RESULT_SCHEMA = "check_name string, object_name string, column_name string, observed bigint, status string"


class DataQualityError(RuntimeError):
    pass


def _status(failed: Column, severity: str = "fail") -> Column:
    return F.when(failed, F.lit(severity)).otherwise(F.lit("pass"))


def _row(check: str, obj: str, column: str, observed: Column, failed: Column,
         severity: str = "fail") -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(obj).alias("object_name"),
            F.lit(column).alias("column_name"), observed.cast("bigint").alias("observed"),
            _status(failed, severity).alias("status")]


def check_not_null(df: DataFrame, cols: Sequence[str], obj: str) -> DataFrame:
    """Q1: one aggregate computes the NULL count of every listed column, then the single
    wide row is unpivoted to one row per column."""
    counts = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c)
                      for c in cols])
    long = counts.unpivot([], list(cols), "column_name", "observed")
    return long.select(F.lit("not_null").alias("check_name"), F.lit(obj).alias("object_name"),
                       "column_name", F.col("observed").cast("bigint").alias("observed"),
                       _status(F.col("observed") > 0).alias("status"))


def check_unique(df: DataFrame, col: str, obj: str) -> DataFrame:
    """Q2: values (NULLs ignored) that occur more than once."""
    dup = (df.select(col).filter(F.col(col).isNotNull()).groupBy(col).count()
             .filter(F.col("count") > 1))
    n = F.count(F.lit(1))
    return dup.agg(n.alias("n")).select(*_row("unique", obj, col, F.col("n"), F.col("n") > 0))


def check_unique_combination(df: DataFrame, cols: Sequence[str], obj: str) -> DataFrame:
    """Q3: key combinations that occur more than once (NULLs compared as values)."""
    dup = df.groupBy(*cols).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("unique_combination", obj, ",".join(cols), F.col("n"), F.col("n") > 0))


def check_non_empty(df: DataFrame, obj: str) -> DataFrame:
    """Q4 as a result row: observed = row count, fails at zero."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("non_empty", obj, "*", F.col("n"), F.col("n") == 0))


def assert_non_empty(df: DataFrame, obj: str) -> None:
    """Q4 as a hard failure; ``isEmpty`` stops at the first row found."""
    if df.isEmpty():
        raise DataQualityError(f"No data found in {obj}")


def check_freshness(df: DataFrame, obj: str, as_of, date_col: str = "date",
                    max_age_days: int = FRESHNESS_DAYS) -> DataFrame:
    """Q5: newest date older than ``max_age_days`` before ``as_of`` warns; no date fails."""
    age = F.datediff(date_value(as_of), F.max(date_col))
    return df.agg(age.alias("age")).select(
        F.lit("freshness").alias("check_name"), F.lit(obj).alias("object_name"),
        F.lit(date_col).alias("column_name"), F.col("age").cast("bigint").alias("observed"),
        F.when(F.col("age").isNull(), F.lit("fail"))
         .when(F.col("age") > max_age_days, F.lit("warn")).otherwise(F.lit("pass"))
         .alias("status"))


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str = "symbol", obj: str = "fact") -> DataFrame:
    """Fact rows whose key has no dimension row (left anti join), as a check row."""
    orphans = fact.select(key).join(dim.select(key), key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("relationships", obj, key, F.col("n"), F.col("n") > 0, "warn"))


def check_model(df: DataFrame, obj: str, not_null: Sequence[str] = (),
                unique: str | None = None, unique_combination: Sequence[str] | None = None,
                non_empty: bool = False, freshness: str | None = None, as_of=None,
                max_age_days: int = FRESHNESS_DAYS) -> DataFrame:
    """All checks of one model from a single aggregate pass, as check rows.

    With a uniqueness key the rows are first pre-aggregated per key value (map-side partial
    counts; a model already partitioned by that key is not re-shuffled) and the NULL
    counts, row count and duplicate count are summed from the groups. Results equal the
    one-check-at-a-time functions above.
    """
    key = [unique] if unique else list(unique_combination or [])
    metrics: list[tuple[str, Column]] = []  # (name, aggregate over the base rows)
    for c in not_null:
        metrics.append((f"nn_{c}", F.sum(F.col(c).isNull().cast("long"))))
    metrics.append(("rows", F.count(F.lit(1))))
    if freshness:
        metrics.append(("max_date", F.max(freshness)))
    if key:
        groups = df.groupBy(*key).agg(*[e.alias(n) for n, e in metrics])
        dup = F.col("rows") > 1
        if unique:
            dup = dup & F.col(unique).isNotNull()
        final = [F.sum(F.col(n)).alias(n) for n, _ in metrics if n != "max_date"]
        if freshness:
            final.append(F.max("max_date").alias("max_date"))
        final.append(F.count_if(dup).alias("dups"))
        wide = groups.agg(*final)
    else:
        wide = df.agg(*[e.alias(n) for n, e in metrics])
    rows = []
    for c in not_null:
        n = F.coalesce(F.col(f"nn_{c}"), F.lit(0))
        rows.append(("not_null", c, n, _status(n > 0)))
    if key:
        d = F.coalesce(F.col("dups"), F.lit(0))
        rows.append(("unique" if unique else "unique_combination", ",".join(key), d, _status(d > 0)))
    if non_empty:
        n = F.coalesce(F.col("rows"), F.lit(0))
        rows.append(("non_empty", "*", n, _status(n == 0)))
    if freshness:
        age = F.datediff(date_value(as_of), F.col("max_date"))
        status = (F.when(age.isNull(), F.lit("fail"))
                   .when(age > max_age_days, F.lit("warn")).otherwise(F.lit("pass")))
        rows.append(("freshness", freshness, age, status))
    structs = [F.struct(F.lit(check).alias("check_name"), F.lit(obj).alias("object_name"),
                        F.lit(col).alias("column_name"), obs.cast("bigint").alias("observed"),
                        st.alias("status"))
               for check, col, obs, st in rows]
    return wide.select(F.inline(F.array(*structs)))
