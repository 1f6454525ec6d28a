"""Logical tables bound onto the driver's testdata.

The usage report and the sales metric layer are written against their own
logical inputs (a metering ledger, five usage-detail logs, a user dimension;
SaaS customers, deals, monthly revenue, support tickets).  The testdata holds
TPC-H tables and an ``events`` stream, so each logical table is defined here
as a projection of those, both as a DataFrame and as the equivalent SQL text
(the latter is used only by the DuckDB differential oracle).

Every binding reads its whole tables.  The mappings below are fixed values chosen so
that the edges the operators handle occur in the data: an unknown family member, a type
outside the family, NULL and empty names, users that the user dimension lacks or repeats.
The report runs on the day after the newest event.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.sources.tables import Sources


def as_of(src: Sources) -> dt.datetime | None:
    """The run time: the start of the day after the newest event (None without events)."""
    newest = src.events.agg(F.max(F.to_date("ts")).alias("d")).first()["d"]
    return None if newest is None else dt.datetime.combine(newest + dt.timedelta(days=1), dt.time())


TODAY_SQL = "(select cast(max(ts) as date) + 1 from events)"


# --- service types by event (sign-ups, purchases and errors split on the props key k) ---
#   click -> web.click; view -> web.view;
#   purchase -> shop.purchase, k >= 97 -> Shop.trial (the family's prefix in another case: outside)
#   signup -> account, k < 14 -> shop.preview (family member, unknown)
#   error -> web.error, k < 33 -> batch.job (outside), k >= 95 -> Web.beta (member, unknown)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _s(x) -> Column:
    return x.cast("string")


def _service_type(k: Column) -> Column:
    et = F.col("event_type")
    return (F.when(et == "click", "web.click")
            .when(et == "view", "web.view")
            .when(et == "purchase", F.when(k >= 97, "Shop.trial").otherwise("shop.purchase"))
            .when(et == "signup", F.when(k < 14, "shop.preview").otherwise("account"))
            .when(et == "error", F.when(k < 33, "batch.job").when(k >= 95, "Web.beta")
                  .otherwise("web.error")))


_K_SQL = "cast(json_extract_string(props, '$.k') as integer)"
_SERVICE_TYPE_SQL = """case event_type
    when 'click' then 'web.click'
    when 'view' then 'web.view'
    when 'purchase' then case when k >= 97 then 'Shop.trial' else 'shop.purchase' end
    when 'signup' then case when k < 14 then 'shop.preview' else 'account' end
    when 'error' then case when k < 33 then 'batch.job' when k >= 95 then 'Web.beta'
                           else 'web.error' end end"""

_EVENTS_K_SQL = f"(select *, {_K_SQL} as k from events)"
_TYPED_EVENTS_SQL = f"(select *, {_SERVICE_TYPE_SQL} as service_type from {_EVENTS_K_SQL})"


def _typed_events(src: Sources) -> DataFrame:
    return src.derived("typed_events", lambda s: s.events.withColumn("k", _k())
                       .withColumn("service_type", _service_type(F.col("k"))))


# --- metering ledger ------------------------------------------------------------
def ledger(src: Sources) -> DataFrame:
    """(service_type, name, start_time, credits_used): one row per event."""
    k = F.col("k")
    name = (F.when(k == 99, F.lit(None).cast("string"))
            .when(k % 20 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("app_"), _s(k % 20))))
    return _typed_events(src).select(
        "service_type", name.alias("name"), F.col("ts").alias("start_time"),
        F.col("value").cast("decimal(28,9)").alias("credits_used"))


LEDGER_SQL = f"""(select service_type,
       case when k = 99 then null when k % 20 = 0 then '' else 'app_' || cast(k % 20 as varchar) end as name,
       ts as start_time, cast(value as decimal(28,9)) as credits_used
from {_TYPED_EVENTS_SQL})"""


def ledger_days(src: Sources) -> DataFrame:
    """Daily ledger: one row per settled usage day."""
    return src.events.select(F.to_date("ts").alias("usage_date")).distinct()


LEDGER_DAYS_SQL = "(select distinct cast(ts as date) as usage_date from events)"


# --- usage-detail logs -------------------------------------------------------------
def _raw_user(k: Column) -> Column:
    return (F.when(k < 40, F.lit(None).cast("string"))
            .when(k == 42, F.lit(""))
            .otherwise(F.concat(F.lit("user_"), _s(F.col("user_id")))))


_RAW_USER_SQL = "case when k < 40 then null when k = 42 then '' else 'user_' || cast(user_id as varchar) end"


# service type -> the event type it comes from (lets the scan filter on a raw
# column before the props key is parsed)
_EVENT_OF = {"web.click": "click", "web.view": "view", "shop.purchase": "purchase",
             "web.error": "error", "account": "signup"}


def _detail(src: Sources, service_type: str) -> DataFrame:
    return _typed_events(src).filter((F.col("event_type") == _EVENT_OF[service_type])
                                     & (F.col("service_type") == service_type))


def _detail_sql(service_type: str) -> str:
    return f"(select * from {_TYPED_EVENTS_SQL} where service_type = '{service_type}')"


def _id() -> Column:
    return F.expr("event_id div 2").cast("string")


def log_clicks(src: Sources) -> DataFrame:
    k = F.col("k")
    return _detail(src, "web.click").select(
        F.col("ts").alias("start_time"),
        F.concat(F.lit("FN_"), _s(k % 5)).alias("function_name"),
        F.when(k % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("model_"), _s(k % 10))).alias("model_name"),
        F.col("value").cast("decimal(28,9)").alias("credits"),
        _id().alias("query_id"), "user_id")


def log_views(src: Sources) -> DataFrame:
    k = F.col("k")
    return _detail(src, "web.view").select(
        F.col("ts").alias("start_time"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("agent_"), _s(k % 8))).alias("agent_name"),
        F.col("value").cast("decimal(28,9)").alias("token_credits"),
        _id().alias("request_id"), "user_id", _raw_user(k).alias("user_name"))


def _log_simple(src: Sources, service_type: str) -> DataFrame:
    k = F.col("k")
    return _detail(src, service_type).select(
        F.col("ts").alias("usage_time"),
        F.col("value").cast("decimal(28,9)").alias("token_credits"),
        _id().alias("request_id"), "user_id", _raw_user(k).alias("user_name"))


def log_purchases(src: Sources) -> DataFrame:
    return _log_simple(src, "shop.purchase")


def log_errors(src: Sources) -> DataFrame:
    return _log_simple(src, "web.error")


def log_signups(src: Sources) -> DataFrame:
    k = F.col("k")
    return _detail(src, "account").select(
        F.col("ts").alias("start_time"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("campaign_"), _s(k % 6))).alias("campaign_name"),
        F.when(k % 2 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("ag_"), _s(k % 4))).alias("agent_name"),
        F.col("value").cast("decimal(28,9)").alias("token_credits"),
        _id().alias("request_id"), "user_id", _raw_user(k).alias("user_name"))


LOG_CLICKS_SQL = f"""(select ts as start_time, 'FN_' || cast(k % 5 as varchar) as function_name,
       case when k % 10 = 0 then '' else 'model_' || cast(k % 10 as varchar) end as model_name,
       cast(value as decimal(28,9)) as credits, cast(event_id // 2 as varchar) as query_id, user_id
from {_detail_sql('web.click')})"""

LOG_VIEWS_SQL = f"""(select ts as start_time,
       case when k % 13 = 0 then null else 'agent_' || cast(k % 8 as varchar) end as agent_name,
       cast(value as decimal(28,9)) as token_credits, cast(event_id // 2 as varchar) as request_id,
       user_id, {_RAW_USER_SQL} as user_name
from {_detail_sql('web.view')})"""


def _log_simple_sql(t: str) -> str:
    return f"""(select ts as usage_time, cast(value as decimal(28,9)) as token_credits,
       cast(event_id // 2 as varchar) as request_id, user_id, {_RAW_USER_SQL} as user_name
from {_detail_sql(t)})"""


LOG_PURCHASES_SQL = _log_simple_sql("shop.purchase")
LOG_ERRORS_SQL = _log_simple_sql("web.error")

LOG_SIGNUPS_SQL = f"""(select ts as start_time,
       case when k % 3 = 0 then null else 'campaign_' || cast(k % 6 as varchar) end as campaign_name,
       case when k % 2 = 1 then null else 'ag_' || cast(k % 4 as varchar) end as agent_name,
       cast(value as decimal(28,9)) as token_credits, cast(event_id // 2 as varchar) as request_id,
       user_id, {_RAW_USER_SQL} as user_name
from {_detail_sql('account')})"""


# --- how the logs map onto the unified detail schema ----------------------------------
@dataclass(frozen=True)
class LogMap:
    """One detail log: its table, service, and SQL expressions (read alike by Spark and
    DuckDB) for the unified columns."""
    table: str
    service: str
    time: str
    credits: str
    usage_id: str
    function: str
    model: str = "cast(null as string)"
    agent: str = "cast(null as string)"
    user: str = "user_name"


DETAIL_LOGS = (
    LogMap("log_clicks", "web.click", "start_time", "credits", "query_id", "function_name",
           model="nullif(model_name, '')", user="cast(null as string)"),
    LogMap("log_errors", "web.error", "usage_time", "token_credits", "request_id", "'error'"),
    LogMap("log_purchases", "shop.purchase", "usage_time", "token_credits", "request_id", "'purchase'"),
    LogMap("log_signups", "account", "start_time", "token_credits", "request_id", "'signup'",
           agent="coalesce(campaign_name, agent_name, '(unknown)')"),
    LogMap("log_views", "web.view", "start_time", "token_credits", "request_id", "'view'",
           agent="coalesce(agent_name, '(unknown)')"),
)


# --- user dimension ------------------------------------------------------------------
def users(src: Sources) -> DataFrame:
    """Every customer is a user with an even id (so events of odd users find none);
    BUILDING customers also have an older second name row (so the dimension needs a
    dedupe)."""
    c = src.customer
    cur = c.select((F.col("c_custkey") * 2).alias("user_id"), F.col("c_name").alias("name"))
    old = (c.filter(F.col("c_mktsegment") == "BUILDING")
           .select((F.col("c_custkey") * 2).alias("user_id"),
                   F.concat("c_name", F.lit("_old")).alias("name")))
    return cur.unionByName(old)


USERS_SQL = """(select c_custkey * 2 as user_id, c_name as name from customer
union all
select c_custkey * 2, c_name || '_old' from customer where c_mktsegment = 'BUILDING')"""


# --- sales tables ------------------------------------------------------------------
def _geo(src: Sources) -> DataFrame:
    # nation and region are fixed-size TPC-H dimensions (25 and 5 rows at any
    # scale factor), so broadcasting their join is bounded by the spec.
    n, r = src.nation, src.region
    return F.broadcast(n.join(r, n["n_regionkey"] == r["r_regionkey"])
                       .select("n_nationkey", "n_name", "r_name"))


def saas_customers(src: Sources) -> DataFrame:
    c = src.customer
    bal = F.col("c_acctbal")
    return c.join(_geo(src), c["c_nationkey"] == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(bal < 3000, "SMB").when(bal < 6000, "Mid-Market").otherwise("Enterprise").alias("company_size"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.when(bal < 2000, "Growth").when(bal < 7000, "Enterprise").otherwise("Strategic").alias("arr_tier"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("c_custkey") % 600).cast("int")).alias("onboarding_date"),
        F.concat(F.lit("am_"), _s(F.col("c_nationkey") % 7)).alias("account_manager"),
        (F.col("c_custkey") % 60 + 40).cast("int").alias("health_score"),
    )


SAAS_CUSTOMERS_SQL = """(select c_custkey as customer_id, c_name as company_name, c_mktsegment as industry,
       case when c_acctbal < 3000 then 'SMB' when c_acctbal < 6000 then 'Mid-Market' else 'Enterprise' end as company_size,
       r_name as region, n_name as country,
       case when c_acctbal < 2000 then 'Growth' when c_acctbal < 7000 then 'Enterprise' else 'Strategic' end as arr_tier,
       cast(date '2024-01-01' + cast(c_custkey % 600 as integer) as date) as onboarding_date,
       'am_' || cast(c_nationkey % 7 as varchar) as account_manager,
       cast(c_custkey % 60 + 40 as integer) as health_score
from customer left join (select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey) g
  on c_nationkey = g.n_nationkey)"""

# Deal stages by order key modulo 5, with win probabilities.
STAGES = ("Closed Won", "Closed Lost", "Negotiation", "Proposal", "Discovery")
WIN_PROB = ("1.00", "0.00", "0.70", "0.40", "0.20")


def deals(src: Sources) -> DataFrame:
    o = src.orders
    # Deal region / industry are the customer's.  The customer side is
    # grouped by its key, so Spark knows it is unique per key: a deals query
    # that uses neither column has the left join removed by the optimizer,
    # and a repeated customer key could never multiply deals.
    c = src.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    cg = (c.join(_geo(src), c["c_nationkey"] == F.col("n_nationkey"), "left")
          .groupBy("c_custkey")
          .agg(F.max("c_mktsegment").alias("c_mktsegment"), F.max("r_name").alias("r_name")))
    m = F.col("o_orderkey") % 5
    stage = F.when(m == 0, STAGES[0])
    prob = F.when(m == 0, F.lit(WIN_PROB[0]))
    for i in range(1, 5):
        stage = stage.when(m == i, STAGES[i])
        prob = prob.when(m == i, F.lit(WIN_PROB[i]))
    close = F.col("o_orderdate").cast("date")
    return o.join(cg, o["o_custkey"] == cg["c_custkey"], "left").select(
        F.col("o_orderkey").alias("deal_id"),
        F.concat(F.lit("deal_"), _s(F.col("o_orderkey"))).alias("deal_name"),
        F.col("o_custkey").alias("customer_id"),
        stage.alias("stage"),
        F.when(F.col("o_orderstatus") == "F", "New Business")
        .when(F.col("o_orderstatus") == "O", "Expansion").otherwise("Renewal").alias("deal_type"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("amount_usd"),
        close.alias("close_date"),
        F.date_sub(close, 30).alias("created_date"),
        F.concat(F.lit("rep_"), _s(F.col("o_custkey") % 12)).alias("sales_rep"),
        F.col("o_orderpriority").alias("product_line"),
        prob.cast("decimal(3,2)").alias("win_probability"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("industry"),
        F.when(m == 1, "Budget").alias("lost_reason"),
    )


def _case_sql(expr: str, values) -> str:
    return "case " + " ".join(f"when {expr} = {i} then {v}" for i, v in enumerate(values)) + " end"


DEALS_SQL = f"""(select o_orderkey as deal_id, 'deal_' || cast(o_orderkey as varchar) as deal_name,
       o_custkey as customer_id,
       {_case_sql('o_orderkey % 5', [f"'{s}'" for s in STAGES])} as stage,
       case when o_orderstatus = 'F' then 'New Business' when o_orderstatus = 'O' then 'Expansion' else 'Renewal' end as deal_type,
       cast(o_totalprice as decimal(15,2)) as amount_usd,
       cast(o_orderdate as date) as close_date,
       cast(cast(o_orderdate as date) - 30 as date) as created_date,
       'rep_' || cast(o_custkey % 12 as varchar) as sales_rep,
       o_orderpriority as product_line,
       cast({_case_sql('o_orderkey % 5', WIN_PROB)} as decimal(3,2)) as win_probability,
       g.r_name as region, g.c_mktsegment as industry,
       case when o_orderkey % 5 = 1 then 'Budget' end as lost_reason
from orders left join (select c_custkey, c_mktsegment, r_name from customer
                       left join (select n_nationkey, r_name from nation join region on n_regionkey = r_regionkey) x
                       on c_nationkey = x.n_nationkey) g
  on o_custkey = g.c_custkey)"""

# Return flag → revenue product line (and its id digit).
PRODUCTS = (("A", "Analytics", 1), ("N", "Data Platform", 2), ("R", "Data Engineering", 3))


def monthly_revenue(src: Sources) -> DataFrame:
    """Customer × month × product revenue.  Lines are pre-aggregated per
    (order, flag) before the join with orders, so the join input is at most
    order-grain × 3."""
    li = src.lineitem
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    lines = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.sum(price * (F.lit(1) - disc)).alias("net"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("qty"),
        F.sum(F.when(F.col("l_discount") >= 0.08, price).otherwise(F.lit(0))).alias("exp"),
        F.max("l_discount").alias("maxdisc"))
    o = src.orders.select("o_orderkey", "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    j = lines.join(o, lines["l_orderkey"] == o["o_orderkey"])
    flag = F.col("l_returnflag")
    prod, idx = F.when(F.lit(False), None), F.when(F.lit(False), None)
    for code, name, digit in PRODUCTS:
        prod, idx = prod.when(flag == code, name), idx.when(flag == code, digit)
    prod, idx = prod.otherwise("Other"), idx.otherwise(4)
    g = j.groupBy("o_custkey", "month", "l_returnflag").agg(
        F.sum("net").cast("decimal(38,4)").alias("mrr_usd"),
        F.sum("qty").cast("bigint").alias("license_count"),
        F.sum("exp").cast("decimal(38,2)").alias("expansion_usd"),
        (F.max("maxdisc") >= 0.10).alias("churn_flag"))
    return g.select(
        (F.col("o_custkey") * 100000
         + ((F.year("month") - 1990) * 12 + F.month("month")) * 10
         + idx).cast("bigint").alias("revenue_id"),
        F.col("o_custkey").alias("customer_id"), "month", "mrr_usd",
        prod.alias("product_line"), "license_count", "expansion_usd", "churn_flag")


MONTHLY_REVENUE_SQL = """(with lines as (
    select l_orderkey, l_returnflag,
           sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) as net,
           sum(cast(l_quantity as decimal(12,2))) as qty,
           sum(case when l_discount >= 0.08 then cast(l_extendedprice as decimal(12,2)) else 0 end) as exp,
           max(l_discount) as maxdisc
    from lineitem group by l_orderkey, l_returnflag),
  g as (
    select o_custkey, cast(date_trunc('month', cast(o_orderdate as date)) as date) as month, l_returnflag,
           cast(sum(net) as decimal(38,4)) as mrr_usd, cast(sum(qty) as bigint) as license_count,
           cast(sum(exp) as decimal(38,2)) as expansion_usd, max(maxdisc) >= 0.10 as churn_flag
    from lines join orders on l_orderkey = o_orderkey
    group by o_custkey, cast(date_trunc('month', cast(o_orderdate as date)) as date), l_returnflag)
  select cast(o_custkey * 100000 + ((year(month) - 1990) * 12 + month(month)) * 10
              + case l_returnflag when 'A' then 1 when 'N' then 2 when 'R' then 3 else 4 end as bigint) as revenue_id,
         o_custkey as customer_id, month, mrr_usd,
         case l_returnflag when 'A' then 'Analytics' when 'N' then 'Data Platform'
              when 'R' then 'Data Engineering' else 'Other' end as product_line,
         license_count, expansion_usd, churn_flag
  from g)"""


def support_tickets(src: Sources) -> DataFrame:
    ev = src.events.withColumn("k", _k())
    k = F.col("k")
    open_ = (k % 5 == 0)
    return ev.select(
        F.col("event_id").alias("ticket_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("created_date"),
        F.when(k < 25, "Critical").when(k < 50, "High").when(k < 75, "Medium").otherwise("Low").alias("priority"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("ticket "), _s(F.col("event_id"))).alias("subject"),
        F.concat(F.lit("reported on "), F.col("event_type")).alias("description"),
        F.when(open_, "In Progress").otherwise("Resolved").alias("status"),
        F.when(open_, F.lit(None)).otherwise(F.col("value")).cast("decimal(10,2)").alias("resolution_hours"),
        F.when(open_, F.lit(None)).otherwise(k % 5 + 1).cast("int").alias("csat_score"),
        F.when(open_, F.lit(None)).otherwise(F.concat(F.lit("fix "), _s(k % 7))).cast("string")
        .alias("resolution"),
    )


SUPPORT_TICKETS_SQL = f"""(select event_id as ticket_id, user_id as customer_id, cast(ts as date) as created_date,
       case when k < 25 then 'Critical' when k < 50 then 'High' when k < 75 then 'Medium' else 'Low' end as priority,
       event_type as category, 'ticket ' || cast(event_id as varchar) as subject,
       'reported on ' || event_type as description,
       case when k % 5 = 0 then 'In Progress' else 'Resolved' end as status,
       cast(case when k % 5 = 0 then null else value end as decimal(10,2)) as resolution_hours,
       cast(case when k % 5 = 0 then null else k % 5 + 1 end as integer) as csat_score,
       case when k % 5 = 0 then null else 'fix ' || cast(k % 7 as varchar) end as resolution
from {_EVENTS_K_SQL})"""


# --- dated rates and cost centres ----------------------------------------------------
def rates(src: Sources) -> DataFrame:
    """(service_type, valid_from, price): in every even month a type has events, a new rate from its
    first event of the month on."""
    month = F.month("ts")
    return (_typed_events(src).where(month % 2 == 0)
            .groupBy("service_type", F.trunc("ts", "MM").alias("m")).agg(F.min("ts").alias("valid_from"))
            .select("service_type", "valid_from",
                    (F.lit(2) + F.month("m") * F.lit(0.125).cast("decimal(4,3)")).cast("decimal(9,4)").alias("price")))


RATES_SQL = f"""(select service_type, valid_from, cast(2 + month(m) * cast(0.125 as decimal(4,3)) as decimal(9,4)) as price
from (select service_type, cast(date_trunc('month', ts) as date) as m, min(ts) as valid_from
      from {_TYPED_EVENTS_SQL} where month(ts) % 2 = 0 group by 1, 2))"""


def centres(src: Sources) -> DataFrame:
    """(name, valid_from, centre, division): the cost centre of the ledger names app_n but for n % 7 = 3,
    anew from the tenth of each month that has events."""
    k = F.col("k") % 20
    m = F.trunc("ts", "MM")
    c = (k + F.month("m")) % 4
    return (_typed_events(src).where((k != 0) & (F.col("k") != 99) & (k % 7 != 3))
            .groupBy(k.alias("n"), m.alias("m")).agg(F.max("k").alias("k"))
            .select(F.concat(F.lit("app_"), _s(F.col("n"))).alias("name"), F.date_add("m", 9).alias("valid_from"),
                    F.concat(F.lit("cc_"), _s(c)).alias("centre"), F.concat(F.lit("div_"), _s(c % 2)).alias("division")))


CENTRES_SQL = f"""(select 'app_' || cast(n as varchar) as name, cast(m + 9 as date) as valid_from,
  'cc_' || cast((n + month(m)) % 4 as varchar) as centre, 'div_' || cast((n + month(m)) % 4 % 2 as varchar) as division
from (select distinct k % 20 as n, cast(date_trunc('month', ts) as date) as m from {_EVENTS_K_SQL}
      where k % 20 <> 0 and k <> 99 and k % 20 % 7 <> 3))"""


class Bound:
    """All logical tables of one testdata directory: lazy DataFrames, each built once
    for this object, from files listed when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = Sources(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name):
        fn = _TABLES.get(name)
        if fn is None or name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = fn(self.src)
        return self._built[name]

    @property
    def as_of(self) -> dt.datetime | None:
        return as_of(self.src)


_TABLES = {
    "ledger": ledger, "ledger_days": ledger_days,
    "log_clicks": log_clicks, "log_views": log_views,
    "log_purchases": log_purchases, "log_errors": log_errors,
    "log_signups": log_signups, "users": users,
    "saas_customers": saas_customers, "deals": deals,
    "monthly_revenue": monthly_revenue, "support_tickets": support_tickets,
    "rates": rates, "centres": centres,
}

SQL = {
    "ledger": LEDGER_SQL, "ledger_days": LEDGER_DAYS_SQL,
    "log_clicks": LOG_CLICKS_SQL, "log_views": LOG_VIEWS_SQL,
    "log_purchases": LOG_PURCHASES_SQL, "log_errors": LOG_ERRORS_SQL,
    "log_signups": LOG_SIGNUPS_SQL, "users": USERS_SQL,
    "saas_customers": SAAS_CUSTOMERS_SQL, "deals": DEALS_SQL,
    "monthly_revenue": MONTHLY_REVENUE_SQL, "support_tickets": SUPPORT_TICKETS_SQL,
    "rates": RATES_SQL, "centres": CENTRES_SQL,
}


def with_ctes(body: str, names: list[str]) -> str:
    """``with name as (...), ... body`` for the given logical tables."""
    return "with " + ", ".join(f"{n} as {SQL[n]}" for n in names) + " " + body
