"""DuckDB SQL equivalents of the mart queries (differential-test oracle).

Tables ``customer orders lineitem`` are the raw source views.
"""

from __future__ import annotations

STG_CUSTOMERS = """
select c_custkey as customer_key, c_name as name, cast(null as varchar) as address,
       c_nationkey as nation_key, cast(null as varchar) as phone,
       cast(c_acctbal as decimal(12,2)) as account_balance,
       c_mktsegment as market_segment, cast(null as varchar) as comment
from customer"""

STG_ORDERS = """
select o_orderkey as order_key, o_custkey as customer_key, o_orderstatus as order_status,
       cast(o_totalprice as decimal(12,2)) as total_price, cast(o_orderdate as date) as order_date,
       o_orderpriority as order_priority, cast(null as varchar) as clerk,
       cast(null as integer) as ship_priority, cast(null as varchar) as comment
from orders"""

STG_LINEITEM = """
select l_orderkey as order_key, l_linenumber as line_number, l_partkey as part_key,
       l_suppkey as supplier_key, cast(l_quantity as decimal(12,2)) as quantity,
       cast(l_extendedprice as decimal(12,2)) as extended_price,
       cast(l_discount as decimal(4,2)) as discount, cast(l_tax as decimal(4,2)) as tax,
       l_returnflag as return_flag, l_linestatus as line_status,
       cast(l_shipdate as date) as ship_date, cast(null as date) as commit_date,
       cast(null as date) as receipt_date
from lineitem"""

_REV = "extended_price * (1 - discount) * (1 + tax)"

LINE_REVENUE = f"""
with l as ({STG_LINEITEM})
select order_key, line_number, cast({_REV} as decimal(38,6)) as line_revenue from l"""

ORDER_REVENUE = f"""
with l as ({STG_LINEITEM})
select order_key, cast(sum({_REV}) as decimal(38,6)) as order_revenue,
       count(*) as line_item_count
from l group by order_key"""

FCT_ORDERS = f"""
with o as ({STG_ORDERS}), r as ({ORDER_REVENUE})
select o.order_key, o.customer_key, o.order_status, o.order_date, o.order_priority,
       r.order_revenue, r.line_item_count
from o join r on o.order_key = r.order_key"""

CUSTOMER_ORDERS = f"""
with f as ({FCT_ORDERS})
select customer_key, count(*) as total_orders,
       cast(sum(order_revenue) as decimal(38,6)) as total_revenue,
       min(order_date) as first_order_date, max(order_date) as last_order_date
from f group by customer_key"""

DIM_CUSTOMERS = f"""
with c as ({STG_CUSTOMERS}), co as ({CUSTOMER_ORDERS})
select c.customer_key, c.name, c.address, c.phone, c.account_balance, c.market_segment,
       coalesce(co.total_orders, 0) as total_orders,
       coalesce(co.total_revenue, cast(0 as decimal(38,6))) as total_revenue,
       co.first_order_date, co.last_order_date
from c left join co on c.customer_key = co.customer_key"""


def _models_cte() -> str:
    return (f"stg_customers as ({STG_CUSTOMERS}), stg_orders as ({STG_ORDERS}), "
            f"stg_lineitem as ({STG_LINEITEM}), fct_orders as ({FCT_ORDERS}), "
            f"dim_customers as ({DIM_CUSTOMERS})")


def _unique(name, model, cols):
    nn = " and ".join(f"{c} is not null" for c in cols)
    cl = ", ".join(cols)
    return (f"select '{name}' as check_name, 'unique' as kind, '{model}' as model, "
            f"'{','.join(cols)}' as column_name, count(*) as failures from "
            f"(select {cl} from {model} where {nn} group by {cl} having count(*) > 1)")


def _not_null(name, model, col):
    return (f"select '{name}' as check_name, 'not_null' as kind, '{model}' as model, "
            f"'{col}' as column_name, count(*) as failures from {model} where {col} is null")


def _rel(name, model, col, to_model, to_col):
    return (f"select '{name}' as check_name, 'relationships' as kind, '{model}' as model, "
            f"'{col}' as column_name, count(*) as failures from {model} c "
            f"where c.{col} is not null and not exists "
            f"(select 1 from {to_model} p where p.{to_col} = c.{col})")


def checks_sql(kinds=None) -> str:
    from martlight.plans.mart_checks import DECLARED, EXTRA
    parts = []
    for ch in DECLARED + EXTRA:
        if kinds is not None and ch.kind not in kinds:
            continue
        cols = [ch.column] if isinstance(ch.column, str) else list(ch.column)
        if ch.kind == "unique":
            parts.append(_unique(ch.name, ch.model, cols))
        elif ch.kind == "not_null":
            parts.append(_not_null(ch.name, ch.model, cols[0]))
        else:
            parts.append(_rel(ch.name, ch.model, cols[0], ch.to_model, ch.to_column))
    return f"with {_models_cte()} " + " union all ".join(parts)


def summary_sql() -> str:
    return (f"with r as ({checks_sql()}) select count(*) as checks, "
            "cast(count_if(failures = 0) as bigint) as passed, "
            "cast(count_if(failures > 0) as bigint) as failed, "
            "cast(sum(failures) as bigint) as failing_rows from r")
