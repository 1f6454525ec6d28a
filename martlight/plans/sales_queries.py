"""Metric-layer and data-generation queries over the bound testdata."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.catalog import register
from martlight.operators import datagen
from martlight.oracle import sales_sql as Q
from martlight.plans.sales import sales_model
from martlight.sources.bindings import Bound

SPINE_START = dt.date(2025, 1, 1)
SPINE_MONTHS = 18


@register("sem_totals", Q.SEM_TOTALS)
def _totals(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_customers", "total_deals", "total_tickets"])


@register("sem_pipeline_by_stage", Q.SEM_PIPELINE_BY_STAGE)
def _pipeline(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_deals", "total_pipeline_value"], ["deal_stage"])


@register("sem_avg_deal_size", Q.SEM_AVG_DEAL_SIZE)
def _avg_deal(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["average_deal_size"],
                                            ["customer_region", "deal_type"])


@register("sem_won_lost_by_rep", Q.SEM_WON_LOST_BY_REP)
def _won_lost(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["won_deals", "lost_deals"], ["sales_rep"])


@register("sem_customers_by_region", Q.SEM_CUSTOMERS_BY_REGION)
def _cust_region(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_customers"], ["customer_region", "arr_tier"])


@register("sem_mrr_trend", Q.SEM_MRR_TREND)
def _mrr_trend(spark, sf_dir):
    """MRR by month and product over the last six months of data."""
    m = sales_model(spark, sf_dir)
    g = m.query(["total_mrr"], ["revenue_month", "rev_product"])
    # The month filter is on a grouping dimension, so it applies to the aggregated rows;
    # the newest month is one value, taken from the same aggregate.
    since = g.agg(F.add_months(F.max("revenue_month"), -6)).scalar()
    return g.filter(F.col("revenue_month") > since)


@register("sem_won_by_region_industry", Q.SEM_WON_BY_REGION_INDUSTRY)
def _won_region(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["won_deals", "lost_deals"],
        ["customer_region", "customer_industry", "company_size", "deal_region", "deal_industry"])


@register("sem_deal_rows", Q.SEM_DEAL_ROWS)
def _deal_rows(spark, sf_dir):
    return sales_model(spark, sf_dir).rows(
        "deals", ["deal_name", "deal_stage", "deal_type", "close_date", "deal_created", "sales_rep",
                  "deal_product", "lost_reason", "win_prob", "deal_amount", "company_name", "country",
                  "account_manager", "onboarding_date"],
        where="deal_stage <> 'Closed Lost' OR customers.country IS NULL")


@register("sem_licenses_by_product", Q.SEM_LICENSES_BY_PRODUCT)
def _licenses(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_licenses", "total_mrr"], ["rev_product", "is_churned"])


@register("sem_tickets_by_status", Q.SEM_TICKETS_BY_STATUS)
def _tickets_status(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["total_tickets"], ["ticket_status", "ticket_category", "ticket_date"],
        where="ticket_priority <> 'Low'")


@register("sem_tickets_by_subject", Q.SEM_TICKETS_BY_SUBJECT)
def _tickets_subject(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["total_tickets", "avg_resolution_hours"], ["ticket_subject", "ticket_priority"])


@register("sem_expansion_by_tier", Q.SEM_EXPANSION_BY_TIER)
def _exp_tier(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_expansion", "total_mrr"], ["arr_tier"])


@register("sem_tickets_by_priority", Q.SEM_TICKETS_BY_PRIORITY)
def _tickets(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["total_tickets", "avg_resolution_hours", "avg_csat"], ["ticket_priority"])


@register("sem_lowest_health", Q.SEM_LOWEST_HEALTH)
def _lowest_health(spark, sf_dir):
    return sales_model(spark, sf_dir).rows(
        "customers", ["company_name", "health"],
        order_by=["health ASC", "company_name ASC"], limit=5)


@register("sem_top_ticket_volume", Q.SEM_TOP_TICKET_VOLUME)
def _top_tickets(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["total_tickets"], ["company_name"],
        order_by=["total_tickets DESC", "company_name ASC"], limit=10)


@register("sem_cross_entity", Q.SEM_CROSS_ENTITY)
def _cross(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["total_pipeline_value", "total_tickets", "total_mrr"], ["customer_region"])


@register("table_row_counts", Q.TABLE_ROW_COUNTS)
def _row_counts(spark, sf_dir):
    b = Bound(spark, sf_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in (("customers", b.saas_customers), ("deals", b.deals),
                              ("monthly_revenue", b.monthly_revenue),
                              ("support_tickets", b.support_tickets))]
    return reduce(DataFrame.unionByName, parts)


@register("product_line_map", Q.PRODUCT_LINE_MAP)
def _product(spark, sf_dir):
    c = Bound(spark, sf_dir).saas_customers
    return c.groupBy(datagen.product_line("customer_id").alias("product_line")).agg(
        F.count(F.lit(1)).alias("n_customers"))


@register("customer_month_spine", Q.CUSTOMER_MONTH_SPINE)
def _cm_spine(spark, sf_dir):
    c = Bound(spark, sf_dir).saas_customers
    return datagen.entity_months(c.select("customer_id", "onboarding_date"), "onboarding_date",
                                 SPINE_START, SPINE_MONTHS).select("customer_id", "month_idx", "month")


@register("monthly_revenue_gen", Q.MONTHLY_REVENUE_GEN)
def _gen(spark, sf_dir):
    return datagen.monthly_revenue(Bound(spark, sf_dir).saas_customers, SPINE_START, SPINE_MONTHS)
