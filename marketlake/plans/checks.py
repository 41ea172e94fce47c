"""The data-quality suite of the models (Q1-Q5), as one result table.

Declared tests: 13 not_null (2 raw sources, 7 staging, 4 mart), 2 unique, 1 unique
combination; plus the load checks: non-empty raw tables and freshness of prices.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from marketlake.operators import quality as q

# (model, [columns]) for each not_null declaration.
NOT_NULL = [
    ("stock_prices_daily", ["close"]),
    ("company_info", ["symbol"]),
    ("stg_stock_prices", ["symbol", "date", "close"]),
    ("stg_company_info", ["symbol"]),
    ("stg_benchmark_series", ["series_ticker", "date", "value"]),
    ("dim_stocks", ["symbol"]),
    ("fact_daily_metrics", ["symbol", "date", "close"]),
]
UNIQUE = [("stg_company_info", "symbol"), ("dim_stocks", "symbol")]
UNIQUE_COMBINATION = [("fact_daily_metrics", ["symbol", "date"])]
NON_EMPTY = ["stock_prices_daily", "company_info", "benchmark_series_daily"]
FRESHNESS = [("stock_prices_daily", "date")]


def run_suite(models: Mapping[str, DataFrame], as_of) -> DataFrame:
    """All checks over ``models`` (name -> DataFrame) as one DataFrame: one aggregate pass
    per model, however many checks it has."""
    nn = {m: cols for m, cols in NOT_NULL}
    uq = dict(UNIQUE)
    combo = dict(UNIQUE_COMBINATION)
    fresh = dict(FRESHNESS)
    names = list(dict.fromkeys([m for m, _ in NOT_NULL] + list(uq) + list(combo)
                               + NON_EMPTY + list(fresh)))
    parts = [q.check_model(models[m], m, not_null=nn.get(m, ()), unique=uq.get(m),
                           unique_combination=combo.get(m), non_empty=m in NON_EMPTY,
                           freshness=fresh.get(m), as_of=as_of)
             for m in names]
    return q.union_checks(parts)
