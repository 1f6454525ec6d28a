"""Declared schemas of the sales tables (customers, deals, monthly revenue,
support tickets).  Money and rates are decimals; dates are DATE."""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, D = StringType(), LongType(), DateType()

CUSTOMERS = _s(("customer_id", L), ("company_name", S), ("industry", S), ("company_size", S),
               ("region", S), ("country", S), ("arr_tier", S), ("onboarding_date", D),
               ("account_manager", S), ("health_score", IntegerType()))

DEALS = _s(("deal_id", L), ("deal_name", S), ("customer_id", L), ("stage", S), ("deal_type", S),
           ("amount_usd", DecimalType(15, 2)), ("close_date", D), ("created_date", D),
           ("sales_rep", S), ("product_line", S), ("win_probability", DecimalType(3, 2)),
           ("region", S), ("industry", S), ("lost_reason", S))

MONTHLY_REVENUE = _s(("revenue_id", L), ("customer_id", L), ("month", D),
                     ("mrr_usd", DecimalType(18, 3)), ("product_line", S), ("license_count", L),
                     ("expansion_usd", DecimalType(12, 2)), ("churn_flag", BooleanType()))

SUPPORT_TICKETS = _s(("ticket_id", L), ("customer_id", L), ("created_date", D), ("priority", S),
                     ("category", S), ("subject", S), ("description", S), ("resolution", S),
                     ("status", S), ("resolution_hours", DecimalType(10, 2)),
                     ("csat_score", IntegerType()))
