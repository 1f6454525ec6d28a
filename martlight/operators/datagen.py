"""Generated data: a month spine, entity × month rows, and tiered metric
draws with dense surrogate ids.

* The spine is a ``sequence`` exploded on the executor (18 rows for the
  default), never a driver-side list.
* Entity × month uses the spine's bounded size: each entity row explodes the
  months from ``max(spine start, onboarding month)`` on — a row-local
  generator, no join, no shuffle.  (The cross join + inequality filter it
  replaces would be a broadcast nested-loop join.)
* Draws are keyed integer hashes, so a value depends only on (keys, salt),
  never on partitioning or task order; the same formula is expressible in
  plain SQL, which lets an external engine reproduce the output.
* Surrogate ids are dense 1..n in (month, entity) order via
  ``operators.ranking.global_row_number`` (no single-partition window).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.functions.dates import months_between_starts
from martlight.operators.ranking import global_row_number

_P = 2147483647  # 2^31 - 1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def portable_draw(lo: int, hi: int, k1, k2, salt: int, seed: int = 42) -> Column:
    """Integer in [lo, hi] from two integer keys: two rounds of modular mixing,
    in 64-bit range for keys below ~10^9 (no overflow under ANSI mode)."""
    x1 = F.pmod(_c(k1).cast("bigint") * 7919 + _c(k2).cast("bigint") * 104729
                + F.lit(salt * 1299709 + seed), F.lit(_P))
    x2 = F.pmod(x1 * x1 + F.lit(12345), F.lit(_P))
    return (F.lit(lo) + F.pmod(x2, F.lit(hi - lo + 1))).cast("bigint")


def portable_draw_sql(lo: int, hi: int, k1: str, k2: str, salt: int, seed: int = 42) -> str:
    x1 = f"(({k1} * 7919 + {k2} * 104729 + {salt * 1299709 + seed}) % {_P})"
    x2 = f"(({x1} * {x1} + 12345) % {_P})"
    return f"cast({lo} + ({x2} % {hi - lo + 1}) as bigint)"


def month_spine(spark: SparkSession, start: dt.date, months: int) -> DataFrame:
    """``months`` first-of-month dates from ``start`` (month index 0..n-1)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("month_idx")
    ).select("month_idx", F.add_months(F.lit(start), F.col("month_idx")).alias("month"))


def entity_months(df: DataFrame, since: str, start: dt.date, months: int) -> DataFrame:
    """One row per entity row and spine month with ``since <= month``."""
    # NULL ``since`` compares as unknown, so such rows get no months (greatest()
    # alone would skip the NULL and return 0)
    first = F.when(F.col(since).isNotNull(),
                   F.greatest(F.lit(0), months_between_starts(F.lit(start), F.col(since))
                              + F.when(F.dayofmonth(since) > 1, 1).otherwise(0)))
    idx = F.explode(F.sequence(first, F.lit(months - 1)))
    # rows whose first month is after the spine (or NULL) are filtered out
    out = df.filter(first <= months - 1).withColumn("month_idx", idx)
    return out.withColumn("month", F.add_months(F.lit(start), F.col("month_idx")))


# Tiered ranges of the generator.
TIER_MRR = {"Strategic": (25000, 45000), "Enterprise": (12000, 28000)}
OTHER_MRR = (3000, 12000)
TIER_LICENSES = {"Strategic": (50, 200), "Enterprise": (20, 80)}
OTHER_LICENSES = (5, 25)
EXPANSION = (1000, 8000)
GROWTH_PER_MONTH = "0.015"
PRODUCT_BY_MOD4 = ("Data Platform", "Analytics", "Data Engineering", "AI/ML")


def _tiered(lo_hi: dict, other: tuple, salt: int) -> Column:
    tier = F.col("arr_tier")
    expr = None
    for name, (lo, hi) in lo_hi.items():
        d = portable_draw(lo, hi, "customer_id", "month_idx", salt)
        expr = F.when(tier == name, d) if expr is None else expr.when(tier == name, d)
    return expr.otherwise(portable_draw(other[0], other[1], "customer_id", "month_idx", salt))


def product_line(customer_id) -> Column:
    """By the remainder modulo 4; a negative remainder or a NULL id takes the last."""
    m = _c(customer_id) % 4
    out = F.when(m == 0, PRODUCT_BY_MOD4[0])
    for i in range(1, 3):
        out = out.when(m == i, PRODUCT_BY_MOD4[i])
    return out.otherwise(PRODUCT_BY_MOD4[3])


def mrr_uplift(base, month_idx) -> Column:
    """Growth applied after the base draw: base × (1 + months × 0.015)."""
    return (_c(base).cast("decimal(12,2)")
            * (F.lit(1) + _c(month_idx).cast("decimal(10,0)") * F.lit(GROWTH_PER_MONTH).cast("decimal(4,3)"))
            ).cast("decimal(18,3)")


def monthly_revenue(customers: DataFrame, start: dt.date, months: int) -> DataFrame:
    """Customer × month revenue rows from onboarding on, with tiered draws
    and dense ids in (month, customer) order."""
    base = entity_months(customers.select("customer_id", "arr_tier", "health_score",
                                          "onboarding_date"),
                         "onboarding_date", start, months)
    expansion = F.when(portable_draw(1, 10, "customer_id", "month_idx", 3) > 7,
                       portable_draw(EXPANSION[0], EXPANSION[1], "customer_id", "month_idx", 4)
                       ).otherwise(F.lit(0).cast("bigint"))
    # a NULL health score is no churn
    churn = F.when((F.col("health_score") < 65)
                   & (portable_draw(1, 10, "customer_id", "month_idx", 5) > 8), True).otherwise(False)
    g = base.select(
        "customer_id", "month", "month_idx",
        mrr_uplift(_tiered(TIER_MRR, OTHER_MRR, 1), "month_idx").alias("mrr_usd"),
        product_line("customer_id").alias("product_line"),
        _tiered(TIER_LICENSES, OTHER_LICENSES, 2).alias("license_count"),
        expansion.cast("decimal(12,2)").alias("expansion_usd"),
        churn.alias("churn_flag"))
    ided = global_row_number(g, ["month", "customer_id"], name="revenue_id")
    return ided.select("revenue_id", "customer_id", "month", "mrr_usd", "product_line",
                       "license_count", "expansion_usd", "churn_flag")


def append_monthly_revenue(customers: DataFrame, start: dt.date, months: int, path: str,
                           batch: str | None = None) -> DataFrame:
    """INSERT INTO monthly_revenue SELECT …: generate rows and append them, conformed to the
    declared schema, to the versioned table at ``path``; its rows come back.

    ``batch`` is the run's identity, by default the months it covers: a repeated run changes
    nothing.  ``revenue_id`` goes on where the table's last batch ended."""
    from martlight.operators.versions import VersionedTable
    from martlight.sources import schemas, sinks
    rows = sinks.conform(monthly_revenue(customers, start, months), schemas.MONTHLY_REVENUE)
    return VersionedTable(customers.sparkSession, path).append(
        rows, batch or f"{start.isoformat()}+{months}", number="revenue_id")
