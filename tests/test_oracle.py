"""Every registered query against its DuckDB oracle (sf0.001 by default; set
MARKETLAKE_ORACLE_SF=/root/testdata/sf0.01 for the driver's scale)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from marketlake.plans.catalog import QUERIES
from marketlake.plans.oracle import ORACLE
from tools.oracle_compare import TABLES, compare, rows_of

SF = os.environ.get("MARKETLAKE_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    exact, worst = compare(rows_of(sdf.columns, srows), rows_of(dcols, drows))
    assert exact, f"max abs diff {worst}"


def test_entry_serves_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert all(entry.oracle_sql()[k] == v for k, v in ORACLE.items())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 19


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_output_columns_are_unique_snake_case(spark, name):
    """The driver sorts columns by name before hashing values: names must be unique."""
    import re
    cols = QUERIES[name](spark, SF_SMALL).columns
    assert len(cols) == len(set(cols)), cols
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", c) for c in cols), cols
