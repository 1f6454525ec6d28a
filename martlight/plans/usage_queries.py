"""Usage-report queries over the bound testdata, registered by name."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.catalog import register
from martlight.oracle import usage_sql as Q
from martlight.operators.settings import ReportSettings
from martlight.plans import usage as U
from martlight.sources import bindings as B

def demo_logs(b: B.Bound) -> list[U.UsageLog]:
    """The detail logs of the bound testdata, each with its own columns."""
    return [U.UsageLog(getattr(b, m.table), m.service, m.time, m.credits, m.usage_id,
                       function_name=F.expr(m.function), model_name=F.expr(m.model),
                       agent_name=F.expr(m.agent), user_name=F.expr(m.user))
            for m in B.DETAIL_LOGS]


class BoundInputs:
    """The inputs of a report over the bound testdata, each opened when it is first read."""
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._bound = B.Bound(spark, sf_dir)

    @property
    def ledger(self) -> DataFrame:
        return self._bound.ledger

    @property
    def ledger_days(self) -> DataFrame:
        return self._bound.ledger_days

    @property
    def users(self) -> DataFrame:
        return self._bound.users

    @cached_property
    def logs(self) -> list[U.UsageLog]:
        return demo_logs(self._bound)

    @cached_property
    def as_of(self) -> dt.datetime:
        """The start of the day after the newest event; without events, now."""
        return self._bound.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def demo_inputs(spark: SparkSession, sf_dir: str) -> BoundInputs:
    return BoundInputs(spark, sf_dir)


def demo_report(spark: SparkSession, sf_dir: str, settings: ReportSettings | None = None,
                write_cubes: bool = False) -> U.UsageReport:
    return U.UsageReport(spark, demo_inputs(spark, sf_dir),
                         settings or ReportSettings.defaults(), write_cubes=write_cubes)


def _raw(spark, sf_dir) -> DataFrame:
    return U.unify_raw(demo_logs(B.Bound(spark, sf_dir)))


@register("users_dedup", Q.USERS_DEDUP)
def _users_dedup(spark, sf_dir):
    return U.users_dedup(B.Bound(spark, sf_dir).users)


@register("unified_usage", Q.UNIFIED_USAGE)
def _unified(spark, sf_dir):
    b = B.Bound(spark, sf_dir)
    return U.unified_usage(demo_logs(b), b.users)


@register("reporting_window", Q.REPORTING_WINDOW)
def _window(spark, sf_dir):
    inp = demo_inputs(spark, sf_dir)
    return U.reporting_window_frame(inp.ledger_days, inp.as_of)


@register("detail_lag", Q.DETAIL_LAG)
def _lag(spark, sf_dir):
    return demo_report(spark, sf_dir).currency()


@register("ledger_cube", Q.LEDGER_CUBE)
def _cube(spark, sf_dir):
    return demo_report(spark, sf_dir).cube


@register("billed_totals", Q.BILLED_TOTALS)
def _billed(spark, sf_dir):
    return demo_report(spark, sf_dir).billed()


@register("detail_totals", Q.DETAIL_TOTALS)
def _detail(spark, sf_dir):
    return demo_report(spark, sf_dir).detail()


@register("known_types", Q.KNOWN_TYPES)
def _known(spark, sf_dir):
    """Each configured known type with its month-to-date billed credits."""
    r = demo_report(spark, sf_dir)
    kn = U.known_types_frame(spark, r.s.known_types)
    mtd = (r.cube.filter(U._in("day", r.window.m_start, r.window.report_day))
           .groupBy("service_type").agg(F.sum("credits").cast(U.CREDITS).alias("credits")))
    return (kn.join(mtd, "service_type", "left")
            .select("service_type", r.s.labels.label("service_type").alias("type_label"),
                    F.coalesce("credits", F.lit(0).cast(U.CREDITS)).alias("credits"),
                    F.col("credits").isNotNull().alias("billed")))


@register("is_ai_service", Q.IS_AI_SERVICE)
def _family(spark, sf_dir):
    """Every distinct ledger service type with its family membership."""
    s = ReportSettings.defaults()
    return (B.Bound(spark, sf_dir).ledger.groupBy("service_type").agg(
        F.count(F.lit(1)).alias("n_rows"))
        .select("service_type", s.family.contains("service_type").alias("in_family"), "n_rows"))


@register("service_label", Q.SERVICE_LABEL)
def _labels(spark, sf_dir):
    s = ReportSettings.defaults()
    return (B.Bound(spark, sf_dir).ledger.select("service_type").distinct()
            .select("service_type", s.labels.label("service_type").alias("type_label")))


@register("new_service_types", Q.NEW_SERVICE_TYPES)
def _new_types(spark, sf_dir):
    return demo_report(spark, sf_dir).new_types()


@register("budget_status", Q.BUDGET_STATUS)
def _budget(spark, sf_dir):
    return demo_report(spark, sf_dir).budget()


@register("usage_by_type", Q.USAGE_BY_TYPE)
def _by_type(spark, sf_dir):
    return demo_report(spark, sf_dir).by_type()


@register("usage_by_type_subtype", Q.USAGE_BY_TYPE_SUBTYPE)
def _by_sub(spark, sf_dir):
    return demo_report(spark, sf_dir).by_type_subtype()


@register("daily_trend", Q.DAILY_TREND)
def _trend(spark, sf_dir):
    return demo_report(spark, sf_dir).trend()


@register("usage_by_function", Q.USAGE_BY_FUNCTION)
def _by_fn(spark, sf_dir):
    return demo_report(spark, sf_dir).by_function()


@register("usage_by_model", Q.USAGE_BY_MODEL)
def _by_model(spark, sf_dir):
    return demo_report(spark, sf_dir).by_model()


@register("usage_by_user", Q.USAGE_BY_USER)
def _by_user(spark, sf_dir):
    return demo_report(spark, sf_dir).by_user()


@register("usage_by_user_function", Q.USAGE_BY_USER_FUNCTION)
def _by_user_fn(spark, sf_dir):
    r = demo_report(spark, sf_dir)
    return U.usage_by_user_function(r.dcube, Q.USER_TOP_N, r.price)


@register("daily_delta", Q.DAILY_DELTA)
def _delta(spark, sf_dir):
    r = demo_report(spark, sf_dir)
    return U.daily_delta(r.cube, r.window)


@register("billed_at_rates", Q.BILLED_AT_RATES)
def _rates(spark, sf_dir):
    b = B.Bound(spark, sf_dir)
    return U.billed_at_rates(b.ledger, b.rates)


@register("cost_centres", Q.COST_CENTRES)
def _centres(spark, sf_dir):
    r = demo_report(spark, sf_dir)
    return U.cost_centres(r.cube, B.Bound(spark, sf_dir).centres, r.window, r.price)


@register("usage_rank", Q.USAGE_RANK)
def _rank(spark, sf_dir):
    """Every user ranked by month-to-date detail credits (no limit)."""
    from martlight.operators.ranking import global_row_number
    r = demo_report(spark, sf_dir)
    g = r.dcube.groupBy("user_name").agg(F.sum("credits").cast(U.CREDITS).alias("credits"))
    return global_row_number(g, ["credits", "user_name"], [True, False], "rn")


@register("usage_profile", Q.USAGE_PROFILE)
def _profile(spark, sf_dir):
    return U.usage_profile(_raw(spark, sf_dir))


@register("mtd_by_service", Q.MTD_BY_SERVICE)
def _mtd(spark, sf_dir):
    inp = demo_inputs(spark, sf_dir)
    return U.mtd_by_service(U.unify_raw(inp.logs), inp.as_of)


@register("reconcile_totals", Q.RECONCILE_TOTALS)
def _reconcile(spark, sf_dir):
    return demo_report(spark, sf_dir, write_cubes=True).reconcile()


@register("format_numbers", Q.FORMAT_NUMBERS)
def _formats(spark, sf_dir):
    """Month-to-date credits per service type in every report number format."""
    from martlight.functions import formatting as fmt
    r = demo_report(spark, sf_dir)
    g = (r.cube.filter(U._in("day", r.window.m_start, r.window.report_day))
         .groupBy("service_type").agg(F.sum("credits").cast(U.CREDITS).alias("credits")))
    # NULL share when the month's total is zero (ANSI division would fail)
    total = g.agg(F.sum(F.col("credits").cast("double"))).scalar()
    share = F.try_divide(F.col("credits").cast("double") * F.lit(100.0), total)
    return g.select("service_type", "credits",
                    fmt.fmt_credits("credits").alias("credits_4dp"),
                    fmt.fmt_credits2("credits").alias("credits_2dp"),
                    fmt.fmt_usd(U._usd("credits", r.price)).alias("usd_text"),
                    fmt.fmt_plain(share, 1).alias("share_pct_text"))
