"""The data tests declared on the order marts, plus extra checks.

The declared tests all pass on well-formed TPC-H data.  Three extra checks, run only
where asked for, are meant to fail on it and show that the counting works:
uniqueness of ``(order_key, line_number)`` (not a key in generated data),
``not_null`` of ``stg_customers.phone`` (absent from some sources) and the
reverse relationship ``stg_orders.order_key → stg_lineitem`` (orders without
lines).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martlight.operators.quality import Check, run_checks
from martlight.operators.versions import VersionedTable
from martlight.plans.marts import Marts, dim_customers
from martlight.session import written

DECLARED = [
    Check("unique", "dim_customers", "customer_key"),
    Check("not_null", "dim_customers", "customer_key"),
    Check("unique", "fct_orders", "order_key"),
    Check("not_null", "fct_orders", "order_key"),
    Check("not_null", "fct_orders", "customer_key"),
    Check("relationships", "fct_orders", "customer_key", "dim_customers", "customer_key"),
    Check("not_null", "fct_orders", "order_revenue"),
    Check("unique", "stg_customers", "customer_key"),
    Check("not_null", "stg_customers", "customer_key"),
    Check("unique", "stg_orders", "order_key"),
    Check("not_null", "stg_orders", "order_key"),
    Check("not_null", "stg_orders", "customer_key"),
    Check("relationships", "stg_orders", "customer_key", "stg_customers", "customer_key"),
    Check("not_null", "stg_lineitem", "order_key"),
    Check("relationships", "stg_lineitem", "order_key", "stg_orders", "order_key"),
    Check("not_null", "stg_lineitem", "line_number"),
]

EXTRA = [
    Check("unique", "stg_lineitem", ("order_key", "line_number")),
    Check("not_null", "stg_customers", "phone"),
    Check("relationships", "stg_orders", "order_key", "stg_lineitem", "order_key"),
]


def run_mart_checks(spark: SparkSession, sf_dir: str, kinds=None,
                    models: dict[str, DataFrame] | None = None, extra: bool = False) -> DataFrame:
    """The declared tests (``extra``: and those meant to fail) of the given kinds.

    The fact is tested several times and feeds the dimension, so it is computed once,
    into the shared folder."""
    checks = [c for c in DECLARED + (EXTRA if extra else []) if kinds is None or c.kind in kinds]
    if models is None:
        m = Marts(spark, sf_dir)
        staged = {"stg_customers": m.stg_customers, "stg_orders": m.stg_orders, "stg_lineitem": m.stg_lineitem}
        fact = written(m.fct_orders, "dq-fct-orders")
        models = {**staged, "fct_orders": fact, "dim_customers": dim_customers(staged["stg_customers"], fact)}
    return run_checks(models, checks)


# what each table model is built from
DEPENDS = {"fct_orders": ("stg_orders", "stg_lineitem"), "dim_customers": ("stg_customers", "fct_orders")}


@dataclass(frozen=True)
class TestResult:
    """One data test of a build: ``status`` is pass, fail or skipped."""
    check_name: str
    model: str
    failures: int | None
    status: str


def build_and_test(spark: SparkSession, sf_dir: str, out_dir: str,
                   checks: list[Check] | None = None) -> list[TestResult]:
    """Build the models in dependency order and test each before anything is built on it.

    A model is skipped, with its tests, if a model it depends on failed a test or was
    skipped; a test that compares with a skipped model is skipped too.  Tables are published as
    versions: a build that dies leaves the last one readable."""
    m = Marts(spark, sf_dir)
    models: dict[str, DataFrame] = {}
    bad: set[str] = set()
    results: list[TestResult] = []
    build = {
        "stg_customers": lambda: m.stg_customers, "stg_orders": lambda: m.stg_orders,
        "stg_lineitem": lambda: m.stg_lineitem,
        "fct_orders": lambda: VersionedTable(spark, f"{out_dir}/fct_orders").rebuild(m.fct_orders),
        "dim_customers": lambda: VersionedTable(spark, f"{out_dir}/dim_customers").rebuild(
            dim_customers(models["stg_customers"], models["fct_orders"])),
    }
    waiting = list(DECLARED if checks is None else checks)
    for name, make in build.items():
        if not bad & set(DEPENDS.get(name, ())):
            models[name] = make()
        else:
            bad.add(name)
        ready = [c for c in waiting if {c.model, c.to_model or c.model} <= set(models)]
        ready = [c for c in ready if name in (c.model, c.to_model)]
        if ready:
            got = {r["check_name"]: r["failures"] for r in run_checks(models, ready).collect()}
            for c in ready:
                n = got[c.name]
                results.append(TestResult(c.name, c.model, n, "fail" if n else "pass"))
                if n:
                    bad.add(c.model)
            waiting = [c for c in waiting if c not in ready]
    return results + [TestResult(c.name, c.model, None, "skipped") for c in waiting]
