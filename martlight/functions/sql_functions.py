"""The Column helpers as session SQL functions, for SQL users.

``register_sql_functions(spark)`` creates temporary SQL functions
(``CREATE TEMPORARY FUNCTION … RETURN expr``); they are inlined into the plan
like any built-in expression (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from martlight.functions.service import DEMO_FAMILY, DEMO_LABELS, ServiceFamily, ServiceLabels


def _q(s: str) -> str:
    return s.replace("'", "''")


def family_sql(f: ServiceFamily, col: str) -> str:
    arms = [f"startswith(lower({col}), '{_q(p.lower())}')" for p in f.ci_prefixes]
    arms += [f"startswith({col}, '{_q(p)}')" for p in f.prefixes]
    arms += [f"{col} = '{_q(e)}'" for e in f.exact]
    return "(" + " OR ".join(arms or ["FALSE"]) + ")"


def _fmt(x: str, places: int) -> str:
    return f"format_number(round(cast(coalesce({x}, 0) as decimal(38,9)), {places}), {places})"


def register_sql_functions(spark: SparkSession, family: ServiceFamily = DEMO_FAMILY,
                           labels: ServiceLabels = DEMO_LABELS) -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    defs = {
        "is_service_family": ("p STRING", "BOOLEAN", family_sql(family, "p")),
        "service_label": ("p STRING", "STRING", labels.sql("p")),
        "fmt_credits": ("p DECIMAL(38,9)", "STRING", _fmt("p", 4)),
        "fmt_credits2": ("p DECIMAL(38,9)", "STRING", _fmt("p", 2)),
        "fmt_usd": ("p DECIMAL(38,9)", "STRING", "concat('$', " + _fmt("p", 2) + ")"),
    }
    for name, (args, ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(defs)
