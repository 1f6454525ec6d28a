"""Plan assertions: pushdown, exchange counts, no single-task sort of raw rows."""
import re

import __spark_entry__ as E
from tests.conftest import SF_MID


def _plan(spark, key):
    df = E.queries()[key](spark, SF_MID)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_ledger_scan_gets_time_range(spark):
    p = _plan(spark, "billed_totals")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-01T00:00\)", p)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,2024-01-31T00:00\)", p)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_fact_is_one_exchange_per_side(spark):
    df = E.queries()["fct_orders"](spark, SF_MID)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning(order_key") == 2
    assert "partial_sum" in p                       # lines pre-aggregated before the join
    # column pruning: the unused price columns are not read
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("o_totalprice" not in s and "l_quantity" not in s for s in schemas)


def test_top_n_uses_take_ordered_not_global_window_over_groups(spark):
    p = _plan(spark, "usage_by_user")
    assert "TakeOrderedAndProject(limit=10" in p
    # the only unpartitioned window ranks the N rows coming out of the limit
    for m in re.finditer(r"Window \[row_number\(\).*?\], \[\], \[", p):
        raise AssertionError("unpartitioned window without ordering: " + m.group(0))


def test_global_rank_has_no_join_without_keys(spark):
    p = _plan(spark, "usage_rank")
    assert "NestedLoop" not in p and "CartesianProduct" not in p
    # the only window without a partition key runs over one count per range
    assert p.count("Window [") == 1 and "CASE WHEN" not in p


def test_semantic_parent_join_after_preaggregation(spark):
    p = _plan(spark, "sem_avg_deal_size")
    # deals are aggregated to (customer_id, deal_type) before the customer join
    assert re.search(r"HashAggregate\(keys=\[customer_id#\d+L, deal_type#\d+\]", p) or \
        re.search(r"HashAggregate\(keys=\[o_custkey#\d+L, .*deal_type", p) or "partial_sum" in p
