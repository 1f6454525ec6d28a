"""A key holding a third of all rows: results stay exact and the hot key is
combined map-side before any join."""
import datetime as dt
from decimal import Decimal

from martlight.operators.semantic import Entity, Metric, Relationship, SemanticModel, dim, fact
from martlight.plans.marts import dim_customers, fct_orders, stg_customers, stg_lineitem, stg_orders


def _tpch(spark, n_orders=3000):
    cust = spark.createDataFrame([(c, f"C{c}", c % 5, 100.0 + c, "SEG") for c in range(50)],
                                 "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    # customer 7 holds a third of all orders
    orders = spark.createDataFrame(
        [(o, 7 if o % 3 == 0 else o % 50, "F", 10.0, dt.datetime(1996, 1, 1) + dt.timedelta(days=o % 900), "1-URGENT")
         for o in range(n_orders)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = spark.createDataFrame(
        [(o, o % 20, 1, ln, 1.0, 100.0, 0.05, 0.10, "N", "O", dt.datetime(1996, 2, 1))
         for o in range(n_orders) for ln in range(1 + o % 3)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return cust, orders, lines


def test_hot_customer_marts_exact(spark):
    cust, orders, lines = _tpch(spark)
    fct = fct_orders(stg_orders(orders), stg_lineitem(lines))
    dim_ = dim_customers(stg_customers(cust), fct)
    hot = dim_.filter("customer_key = 7").first()
    n_hot = sum(1 for o in range(3000) if o % 3 == 0 or o % 50 == 7)
    lines_hot = sum(1 + o % 3 for o in range(3000) if o % 3 == 0 or o % 50 == 7)
    assert hot["total_orders"] == n_hot
    assert hot["total_revenue"] == Decimal("104.500000") * lines_hot   # 100 × 0.95 × 1.10
    plan = dim_._jdf.queryExecution().executedPlan().toString()
    # per-customer partial aggregate happens before the exchange on customer_key
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(customer_key")


def test_hot_parent_in_metric_layer(spark):
    parents = spark.createDataFrame([(p, "R" + str(p % 2)) for p in range(40)], "pid long, region string")
    facts = spark.createDataFrame([(i, 3 if i % 3 == 0 else i % 40, Decimal(1)) for i in range(3000)],
                                  "fid long, pid long, amount decimal(15,2)")
    m = SemanticModel([Entity("p", parents, "pid"), Entity("f", facts, "fid")],
                      [Relationship("f", "pid", "p")],
                      [dim("p", "region", "region"), fact("f", "amt", "amount")],
                      [Metric.of("f", "total", "SUM(amt)"), Metric.of("f", "n", "COUNT(fid)")])
    q = m.query(["total", "n"], ["region"])
    got = {r["region"]: (r["total"], r["n"]) for r in q.collect()}
    exp = {}
    for i in range(3000):
        p = 3 if i % 3 == 0 else i % 40
        reg = "R" + str(p % 2)
        t, n = exp.get(reg, (0, 0))
        exp[reg] = (t + 1, n + 1)
    assert {k: (int(v[0]), v[1]) for k, v in got.items()} == exp
    plan = q._jdf.queryExecution().executedPlan().toString()
    # facts are aggregated per parent key before the parent join
    join_at = plan.index("Join")
    assert "partial_sum" in plan[join_at:]
