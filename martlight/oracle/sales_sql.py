"""DuckDB SQL equivalents of the metric-layer and generator queries."""

from __future__ import annotations

from martlight.operators.datagen import PRODUCT_BY_MOD4, portable_draw_sql as D
from martlight.sources.bindings import SQL as BSQL

_T = {"customers": "saas_customers", "deals": "deals",
      "monthly_revenue": "monthly_revenue", "support_tickets": "support_tickets"}


def _with(body: str, tables=("customers", "deals", "monthly_revenue", "support_tickets"),
          extra: list[tuple[str, str]] = ()) -> str:
    parts = [f"{name} as {BSQL[_T[name]]}" for name in tables]
    parts += [f"{n} as ({q})" for n, q in extra]
    return "with " + ",\n".join(parts) + "\n" + body


def avg_dec(x: str, precision: int, scale: int = 2) -> str:
    """Exact average of a decimal(precision, scale), rounded HALF_UP once to 4 more digits
    (DuckDB would divide decimals in floating point)."""
    up = 10 ** (scale + 4)
    u = f"cast(sum({x}) * {up} as hugeint)"
    n = f"count({x})"
    one = f"cast('{10 ** -(scale + 4):.{scale + 4}f}' as decimal({scale + 5},{scale + 4}))"
    return (f"case when {n} > 0 then cast(cast(sign({u}) * ((2 * abs({u}) + {n}) // (2 * {n})) as decimal(28,0))"
            f" * {one} as decimal({precision + 4},{scale + 4})) end")


SEM_TOTALS = _with("""select (select count(customer_id) from customers) as total_customers,
       (select count(deal_id) from deals) as total_deals,
       (select count(ticket_id) from support_tickets) as total_tickets""")

SEM_PIPELINE_BY_STAGE = _with("""select stage as deal_stage, count(deal_id) as total_deals,
       cast(sum(amount_usd) as decimal(38,2)) as total_pipeline_value
from deals group by stage""", ("deals", "customers"))

SEM_AVG_DEAL_SIZE = _with(f"""select c.region as customer_region, d.deal_type,
       {avg_dec('d.amount_usd', 15)} as average_deal_size
from deals d left join customers c on d.customer_id = c.customer_id
group by c.region, d.deal_type""", ("deals", "customers"))

SEM_WON_LOST_BY_REP = _with("""select sales_rep, cast(count_if(stage = 'Closed Won') as bigint) as won_deals,
       cast(count_if(stage = 'Closed Lost') as bigint) as lost_deals
from deals group by sales_rep""", ("deals", "customers"))

SEM_CUSTOMERS_BY_REGION = _with("""select region as customer_region, arr_tier, count(customer_id) as total_customers
from customers group by region, arr_tier""", ("customers",))

SEM_WON_BY_REGION_INDUSTRY = _with("""select c.region as customer_region, c.industry as customer_industry,
       c.company_size, d.region as deal_region, d.industry as deal_industry,
       cast(count_if(d.stage = 'Closed Won') as bigint) as won_deals,
       cast(count_if(d.stage = 'Closed Lost') as bigint) as lost_deals
from deals d left join customers c on d.customer_id = c.customer_id group by 1, 2, 3, 4, 5""",
                                   ("deals", "customers"))

SEM_DEAL_ROWS = _with("""select d.deal_name, d.stage as deal_stage, d.deal_type, d.close_date,
       d.created_date as deal_created, d.sales_rep, d.product_line as deal_product, d.lost_reason,
       d.win_probability as win_prob, d.amount_usd as deal_amount, c.company_name, c.country,
       c.account_manager, c.onboarding_date
from deals d left join customers c on d.customer_id = c.customer_id
where d.stage <> 'Closed Lost' or c.country is null""", ("deals", "customers"))

SEM_LICENSES_BY_PRODUCT = _with("""select product_line as rev_product, churn_flag as is_churned,
       cast(sum(license_count) as bigint) as total_licenses, cast(sum(mrr_usd) as decimal(38,4)) as total_mrr
from monthly_revenue group by 1, 2""", ("monthly_revenue",))

SEM_TICKETS_BY_STATUS = _with("""select status as ticket_status, category as ticket_category,
       created_date as ticket_date, count(ticket_id) as total_tickets from support_tickets
where priority <> 'Low' group by 1, 2, 3""", ("support_tickets",))

SEM_MRR_TREND = _with("""select month as revenue_month, product_line as rev_product,
       cast(sum(mrr_usd) as decimal(38,4)) as total_mrr
from monthly_revenue
where month > (select cast(max(month) - interval 6 month as date) from monthly_revenue)
group by month, product_line""", ("monthly_revenue",))

SEM_EXPANSION_BY_TIER = _with("""select c.arr_tier, cast(sum(m.expansion_usd) as decimal(38,2)) as total_expansion,
       cast(sum(m.mrr_usd) as decimal(38,4)) as total_mrr
from monthly_revenue m left join customers c on m.customer_id = c.customer_id
group by c.arr_tier""", ("monthly_revenue", "customers"))

SEM_TICKETS_BY_PRIORITY = _with(f"""select priority as ticket_priority, count(ticket_id) as total_tickets,
       {avg_dec('resolution_hours', 10)} as avg_resolution_hours, cast(avg(csat_score) as double) as avg_csat
from support_tickets group by priority""", ("support_tickets",))

SEM_TICKETS_BY_SUBJECT = _with(f"""select subject as ticket_subject, priority as ticket_priority,
       count(ticket_id) as total_tickets, {avg_dec('resolution_hours', 10)} as avg_resolution_hours
from support_tickets group by 1, 2""", ("support_tickets",))

SEM_LOWEST_HEALTH = _with("""select company_name, health_score as health from customers
order by health_score asc, company_name asc limit 5""", ("customers",))

SEM_TOP_TICKET_VOLUME = _with("""select c.company_name, count(t.ticket_id) as total_tickets
from support_tickets t left join customers c on t.customer_id = c.customer_id
group by c.company_name order by total_tickets desc, c.company_name asc limit 10""",
                              ("support_tickets", "customers"))

SEM_CROSS_ENTITY = _with("""select customer_region, max(total_pipeline_value) as total_pipeline_value,
       max(total_tickets) as total_tickets, max(total_mrr) as total_mrr
from (select c.region as customer_region, cast(sum(d.amount_usd) as decimal(38,2)) as total_pipeline_value,
             cast(null as bigint) as total_tickets, cast(null as decimal(38,4)) as total_mrr
      from deals d left join customers c on d.customer_id = c.customer_id group by 1
      union all
      select c.region, null, count(t.ticket_id), null
      from support_tickets t left join customers c on t.customer_id = c.customer_id group by 1
      union all
      select c.region, null, null, cast(sum(m.mrr_usd) as decimal(38,4))
      from monthly_revenue m left join customers c on m.customer_id = c.customer_id group by 1)
group by customer_region""")

TABLE_ROW_COUNTS = _with("""select 'customers' as table_name, count(*) as n_rows from customers
union all select 'deals', count(*) from deals
union all select 'monthly_revenue', count(*) from monthly_revenue
union all select 'support_tickets', count(*) from support_tickets""")

_PRODUCT = ("case customer_id % 4 " + " ".join(
    f"when {i} then '{p}'" for i, p in enumerate(PRODUCT_BY_MOD4[:3])) + f" else '{PRODUCT_BY_MOD4[3]}' end")

PRODUCT_LINE_MAP = _with(f"""select {_PRODUCT} as product_line, count(*) as n_customers
from customers group by 1""", ("customers",))

_SPINE = """select cast(i as integer) as month_idx, cast(date '2025-01-01' + to_months(i) as date) as month
from range(0, 18) t(i)"""

_CM = f"""select c.customer_id, c.arr_tier, c.health_score, m.month_idx, m.month
from customers c, ({_SPINE}) m where c.onboarding_date <= m.month"""

CUSTOMER_MONTH_SPINE = _with("select customer_id, month_idx, month from cm", ("customers",),
                             [("cm", _CM)])


def _tier(ranges: dict, other: tuple, salt: int) -> str:
    w = " ".join(f"when arr_tier = '{t}' then {D(lo, hi, 'customer_id', 'month_idx', salt)}"
                 for t, (lo, hi) in ranges.items())
    return f"case {w} else {D(other[0], other[1], 'customer_id', 'month_idx', salt)} end"


def _gen() -> str:
    from martlight.operators.datagen import (
        EXPANSION, OTHER_LICENSES, OTHER_MRR, TIER_LICENSES, TIER_MRR)
    mrr = (f"cast(cast({_tier(TIER_MRR, OTHER_MRR, 1)} as decimal(12,2)) * "
           f"(1 + cast(month_idx as decimal(10,0)) * cast('0.015' as decimal(4,3))) as decimal(18,3))")
    exp = (f"cast(case when {D(1, 10, 'customer_id', 'month_idx', 3)} > 7 then "
           f"{D(EXPANSION[0], EXPANSION[1], 'customer_id', 'month_idx', 4)} else 0 end as decimal(12,2))")
    churn = f"coalesce(health_score < 65 and {D(1, 10, 'customer_id', 'month_idx', 5)} > 8, false)"
    return f"""select cast(row_number() over (order by month, customer_id) as bigint) as revenue_id,
       customer_id, month, {mrr} as mrr_usd, {_PRODUCT} as product_line,
       {_tier(TIER_LICENSES, OTHER_LICENSES, 2)} as license_count, {exp} as expansion_usd,
       {churn} as churn_flag
from cm"""


MONTHLY_REVENUE_GEN = _with(_gen(), ("customers",), [("cm", _CM)])
