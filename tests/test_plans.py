"""Plan assertions: the physical plans the operators are designed to produce."""

import re

import pytest

from conftest import SF_SMALL
from marketlake.plans.catalog import QUERIES


def plan_of(df) -> str:
    """The physical plan; for an already executed adaptive plan, only its final plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    if "BroadcastNestedLoopJoin" in plan:
        # Only the optimizer's existence test: when a join key is a constant in every union
        # branch (the watermark fixture's dataset names), the anti join folds into
        # "does any row exist", whose broadcast side is LIMIT 1.
        assert name in {"watermark_upsert"} and "Limit 1" in plan
    # every window is partitioned by an entity key
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        assert not spec.startswith("specifiedwindowframe"), spec


def test_flagship_plan_shape(spark):
    plan = plan_of(QUERIES["fact_daily_metrics"](spark, SF_SMALL))
    # the prices are deduplicated map-side before the first shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the per-date benchmark pivot is broadcast; the company side joins by symbol
    assert re.search(r"BroadcastHashJoin \[date", plan)
    assert re.search(r"SortMergeJoin \[symbol", plan) or re.search(r"BroadcastHashJoin \[symbol", plan)
    # the events scan reads only the columns it needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double," \
           "props:string>" in plan


def test_prices_shuffled_on_version_key_then_symbol(spark):
    plan = plan_of(QUERIES["stg_stock_prices"](spark, SF_SMALL))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 2
    assert exchanges[0].startswith("symbol") and ", date" not in exchanges[0]
    assert "date" in exchanges[1]


def test_screener_adds_no_shuffle_on_fact(spark):
    """The per-symbol pre-aggregation reuses the fact's symbol partitioning."""
    fact_plan = plan_of(QUERIES["fact_daily_metrics"](spark, SF_SMALL))
    summary_plan = plan_of(QUERIES["stock_summary"](spark, SF_SMALL))
    n_fact = len(re.findall(r"Exchange hashpartitioning", fact_plan))
    n_summary = len(re.findall(r"Exchange hashpartitioning", summary_plan))
    # the summary adds only the dimension's own dedup exchange (plus the ORDER BY range one)
    assert n_summary <= n_fact + 1


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["universe_prices"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan


def test_no_join_is_hinted(spark):
    """With the size threshold off, no data join is a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fact_daily_metrics", "fact_long_history", "price_trend"):
            assert "BroadcastHashJoin" not in plan_of(QUERIES[name](spark, SF_SMALL)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_queries_without_company_columns_have_no_company_join(spark):
    for name in ("home_kpis", "vix_overlay", "benchmark_comparison", "performance_stats"):
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        if name != "home_kpis":  # its stock count reads the dimension on its own
            assert "customer" not in plan, name
        assert not re.search(r"Join \[symbol", plan), name


def test_price_trend_deduplicates_prices_once(spark):
    plan = plan_of(QUERIES["price_trend"](spark, SF_SMALL))
    partial = re.findall(r"WindowGroupLimit \[symbol#\d+L?, date#\d+\].*Partial", plan)
    assert len(partial) == 1
