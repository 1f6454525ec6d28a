"""The SaaS sales metric model: four entities in a star around customers."""

from __future__ import annotations

from pyspark.sql import SparkSession

from martlight.operators.semantic import (
    Entity, Metric, Relationship, SemanticModel, dim, fact)
from martlight.sources.bindings import Bound


def sales_model(spark: SparkSession, sf_dir: str, tables: dict | None = None) -> SemanticModel:
    """``tables`` may supply the four DataFrames (customers, deals,
    monthly_revenue, support_tickets); by default they are the bindings of
    ``sf_dir``, each opened when a query first reads it."""
    if tables is None:
        b = Bound(spark, sf_dir)
        tables = {"customers": lambda: b.saas_customers, "deals": lambda: b.deals,
                  "monthly_revenue": lambda: b.monthly_revenue,
                  "support_tickets": lambda: b.support_tickets}
    entities = [
        Entity("customers", tables["customers"], "customer_id"),
        Entity("deals", tables["deals"], "deal_id"),
        Entity("monthly_revenue", tables["monthly_revenue"], "revenue_id"),
        Entity("support_tickets", tables["support_tickets"], "ticket_id"),
    ]
    relationships = [
        Relationship("deals", "customer_id", "customers"),
        Relationship("monthly_revenue", "customer_id", "customers"),
        Relationship("support_tickets", "customer_id", "customers"),
    ]
    # The logical names of the model (facts, dimensions, metrics).
    fields = [
        fact("deals", "deal_amount", "amount_usd"),
        fact("deals", "win_prob", "win_probability"),
        fact("monthly_revenue", "mrr", "mrr_usd"),
        fact("monthly_revenue", "expansion", "expansion_usd"),
        fact("monthly_revenue", "licenses", "license_count"),
        fact("customers", "health", "health_score"),
        fact("support_tickets", "hours_to_resolve", "resolution_hours"),
        fact("support_tickets", "csat", "csat_score"),
        dim("customers", "company_name", "company_name"),
        dim("customers", "customer_industry", "industry"),
        dim("customers", "company_size", "company_size"),
        dim("customers", "customer_region", "region"),
        dim("customers", "country", "country"),
        dim("customers", "arr_tier", "arr_tier"),
        dim("customers", "onboarding_date", "onboarding_date"),
        dim("customers", "account_manager", "account_manager"),
        dim("deals", "deal_name", "deal_name"),
        dim("deals", "deal_stage", "stage"),
        dim("deals", "deal_type", "deal_type"),
        dim("deals", "close_date", "close_date"),
        dim("deals", "deal_created", "created_date"),
        dim("deals", "sales_rep", "sales_rep"),
        dim("deals", "deal_product", "product_line"),
        dim("deals", "deal_region", "region"),
        dim("deals", "deal_industry", "industry"),
        dim("deals", "lost_reason", "lost_reason"),
        dim("monthly_revenue", "revenue_month", "month"),
        dim("monthly_revenue", "rev_product", "product_line"),
        dim("monthly_revenue", "is_churned", "churn_flag"),
        dim("support_tickets", "ticket_date", "created_date"),
        dim("support_tickets", "ticket_priority", "priority"),
        dim("support_tickets", "ticket_category", "category"),
        dim("support_tickets", "ticket_subject", "subject"),
        dim("support_tickets", "ticket_status", "status"),
    ]
    metrics = [
        Metric.of("customers", "total_customers", "COUNT(customer_id)"),
        Metric.of("deals", "total_deals", "COUNT(deal_id)"),
        Metric.of("deals", "total_pipeline_value", "SUM(deal_amount)"),
        Metric.of("deals", "average_deal_size", "AVG(deal_amount)"),
        Metric.of("deals", "won_deals", "COUNT_IF(deal_stage = 'Closed Won')"),
        Metric.of("deals", "lost_deals", "COUNT_IF(deal_stage = 'Closed Lost')"),
        Metric.of("monthly_revenue", "total_mrr", "SUM(mrr)"),
        Metric.of("monthly_revenue", "total_expansion", "SUM(expansion)"),
        Metric.of("monthly_revenue", "total_licenses", "SUM(licenses)"),
        Metric.of("support_tickets", "total_tickets", "COUNT(ticket_id)"),
        Metric.of("support_tickets", "avg_resolution_hours", "AVG(hours_to_resolve)"),
        Metric.of("support_tickets", "avg_csat", "AVG(csat)"),
    ]
    return SemanticModel(entities, relationships, fields, metrics)
