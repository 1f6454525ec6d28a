"""Registry of named queries: ``queries()`` (Spark) and ``oracle_sql()``
(DuckDB text over the raw testdata views) share the same keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.oracle import marts_sql as msql
from martlight.plans import mart_checks
from martlight.plans.marts import Marts, customer_orders, line_revenue, order_revenue

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query function (and its DuckDB SQL) under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


# --- marts -------------------------------------------------------------------
register("stg_customers", msql.STG_CUSTOMERS)(lambda s, d: Marts(s, d).stg_customers)
register("stg_orders", msql.STG_ORDERS)(lambda s, d: Marts(s, d).stg_orders)
register("stg_lineitem", msql.STG_LINEITEM)(lambda s, d: Marts(s, d).stg_lineitem)
register("line_revenue", msql.LINE_REVENUE)(lambda s, d: line_revenue(Marts(s, d).stg_lineitem))
register("order_revenue", msql.ORDER_REVENUE)(lambda s, d: order_revenue(Marts(s, d).stg_lineitem))
register("fct_orders", msql.FCT_ORDERS)(lambda s, d: Marts(s, d).fct_orders)
register("customer_orders", msql.CUSTOMER_ORDERS)(lambda s, d: customer_orders(Marts(s, d).fct_orders))
register("dim_customers", msql.DIM_CUSTOMERS)(lambda s, d: Marts(s, d).dim_customers)


@register("fct_orders_roundtrip", msql.FCT_ORDERS)
def _fct_roundtrip(spark, sf_dir):
    """Table materialization: write the fact to the shared folder, read it back."""
    from martlight.plans.marts import materialize
    from martlight.session import fresh_dir
    return materialize(Marts(spark, sf_dir).fct_orders, fresh_dir(spark, "fct_orders"))


@register("fct_orders_incremental", msql.FCT_ORDERS)
def _fct_incremental(spark, sf_dir):
    """The fact as of the newest order date but one, refreshed to the whole tables part by part."""
    from martlight.plans.incremental import IncrementalFact
    from martlight.session import fresh_dir
    m = Marts(spark, sf_dir)
    newest = m.stg_orders.agg(F.max("order_date")).first()[0]
    fact = IncrementalFact(spark, fresh_dir(spark, "fct_orders_parts"), span=10_000)
    fact.refresh(m.stg_orders.where(F.col("order_date") < F.lit(newest)), m.stg_lineitem)
    fact.refresh(m.stg_orders, m.stg_lineitem)
    return fact.read()


register("dq_unique", msql.checks_sql(["unique"]))(
    lambda s, d: mart_checks.run_mart_checks(s, d, ["unique"], extra=True))
register("dq_not_null", msql.checks_sql(["not_null"]))(
    lambda s, d: mart_checks.run_mart_checks(s, d, ["not_null"], extra=True))
register("dq_relationships", msql.checks_sql(["relationships"]))(
    lambda s, d: mart_checks.run_mart_checks(s, d, ["relationships"], extra=True))


@register("dq_summary", msql.summary_sql())
def _dq_summary(spark, sf_dir):
    from martlight.operators.quality import summarize
    return summarize(mart_checks.run_mart_checks(spark, sf_dir, extra=True))


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose the logical tables and marts of ``sf_dir`` as temporary views
    (lazy named queries) for SQL users."""
    from martlight.sources.bindings import Bound, _TABLES
    b, m = Bound(spark, sf_dir), Marts(spark, sf_dir)
    views = {name: getattr(b, name) for name in _TABLES}
    views.update({n: getattr(m, n) for n in ("stg_customers", "stg_orders", "stg_lineitem",
                                             "fct_orders", "dim_customers")})
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def queries() -> dict[str, QueryFn]:
    """All registered query functions by name."""
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # these modules register their queries on import
    from martlight.plans import report_queries, sales_queries, usage_queries  # noqa: F401
