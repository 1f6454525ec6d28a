"""Metered-usage reporting: unify usage logs, settle the reporting window,
total billed and detail credits, flag unknown service types, rank drill-downs.

Scale notes
-----------
* The reporting window (report day, month start, week start) is three dates
  computed by one aggregate and brought to the driver; every later filter is
  then a literal timestamp range that reaches the parquet scan
  (``PushedFilters``), instead of a join against a one-row frame.
* All billed sections derive from one **ledger cube**
  ``(day, service_type, name) → credits``: one scan and one partially
  aggregated shuffle of the ledger instead of one scan per section.  The cube
  has (days × types × names) rows, independent of row count.
* All detail drill-downs derive from one **detail cube** grouped by
  (service, function, model, agent, user id, raw user name) *before* the user
  dimension is joined, so the join sees one row per group, not per request,
  and a user with a third of all requests is one row after map-side combine.
* Top-N + Others never sorts all groups in one task (operators.topn).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.functions.dates import ts_lit
from martlight.functions.service import ServiceFamily, ServiceLabels
from martlight.operators.settings import ReportSettings
from martlight.operators.asof import as_of_join
from martlight.operators.topn import top_n_with_others, top_n_within
from martlight.session import written

CREDITS = "decimal(38,9)"
USD = "decimal(38,2)"
UNKNOWN = "(unknown)"


# --- unified usage -----------------------------------------------------------
@dataclass(frozen=True)
class UsageLog:
    """How one usage-detail log maps onto the unified detail schema."""

    df: DataFrame
    service: str
    time: str
    credits: str
    usage_id: str
    function_name: Column
    model_name: Column | None = None
    agent_name: Column | None = None
    user_name: Column | None = None
    user_id: str = "user_id"

    def aligned(self) -> DataFrame:
        null = F.lit(None).cast("string")
        return self.df.select(
            F.col(self.usage_id).cast("string").alias("usage_id"),
            F.col(self.time).alias("usage_time"),
            F.lit(self.service).alias("service"),
            self.function_name.cast("string").alias("function_name"),
            (self.model_name if self.model_name is not None else null).alias("model_name"),
            (self.agent_name if self.agent_name is not None else null).alias("agent_name"),
            F.col(self.credits).cast(CREDITS).alias("credits"),
            F.col(self.user_id).cast("bigint").alias("user_id"),
            (self.user_name if self.user_name is not None else null).alias("user_name_raw"),
        )


def unify_raw(logs: list[UsageLog]) -> DataFrame:
    """UNION ALL of the aligned logs (no user lookup yet)."""
    return reduce(DataFrame.unionByName, [lg.aligned() for lg in logs])


def users_dedup(users: DataFrame) -> DataFrame:
    """One name per user id (``max``), so a repeated user row cannot double
    the credits joined to it."""
    return users.groupBy("user_id").agg(F.max("name").alias("user_name"))


def resolve_user(raw_name: str = "user_name_raw", dim_name: str = "user_name") -> Column:
    """Raw name first, then the dimension's, then ``(unknown)``; an empty raw
    name is kept as is."""
    return F.coalesce(F.col(raw_name), F.col(dim_name), F.lit(UNKNOWN))


def unified_usage(logs: list[UsageLog], users: DataFrame) -> DataFrame:
    """One row per request across all logs, user name resolved."""
    raw = unify_raw(logs)
    return raw.join(users_dedup(users), "user_id", "left").select(
        "usage_id", "usage_time", "service", "function_name", "model_name",
        "agent_name", "credits", resolve_user().alias("user_name"))


# --- reporting window ---------------------------------------------------------
@dataclass(frozen=True)
class ReportWindow:
    """Latest settled day, its month start and the first day of its week."""
    report_day: dt.date | None
    m_start: dt.date | None
    wk_start: dt.date | None

    @property
    def lo(self) -> dt.date | None:
        if self.report_day is None:
            return None
        return min(self.m_start, self.wk_start)


def reporting_window_frame(ledger_days: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row: the latest settled day before ``as_of``'s UTC date, its month
    start and the first day of its 7-day window (which may fall in the
    previous month)."""
    today = as_of.date()
    d = (ledger_days.filter(F.col("usage_date") < F.lit(today))
         .agg(F.max("usage_date").alias("report_day")))
    return d.select("report_day",
                    F.trunc("report_day", "MM").alias("m_start"),
                    F.date_sub("report_day", 6).alias("wk_start"))


def reporting_window(ledger_days: DataFrame, as_of: dt.datetime) -> ReportWindow:
    r = reporting_window_frame(ledger_days, as_of).first()
    return ReportWindow(r["report_day"], r["m_start"], r["wk_start"])


def _day_range(ts: str, lo: dt.date | None, hi: dt.date | None) -> Column:
    """``to_date(ts) BETWEEN lo AND hi`` as a half-open timestamp range, which
    the parquet scan receives as pushed filters."""
    if lo is None or hi is None:
        return F.lit(False)
    start = dt.datetime.combine(lo, dt.time())
    end = dt.datetime.combine(hi + dt.timedelta(days=1), dt.time())
    return (F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(end))


def detail_currency(raw: DataFrame, w: ReportWindow) -> DataFrame:
    """How far the detail logs have settled: latest detail day ≤ report day
    (report day if none), the lag in days and its badge text."""
    if w.report_day is None:
        rd = F.lit(None).cast("date")
        cond = F.lit(False)
    else:
        rd = F.lit(w.report_day)
        cond = F.col("usage_time") < ts_lit(dt.datetime.combine(
            w.report_day + dt.timedelta(days=1), dt.time()))
    d = raw.filter(cond).agg(F.max(F.to_date("usage_time")).alias("mx"))
    lag = F.datediff(rd, F.col("detail_max_day")).cast("bigint")
    return (d.select(F.coalesce("mx", rd).alias("detail_max_day"))
            .select("detail_max_day", lag.alias("detail_lag"))
            .select("detail_max_day", "detail_lag",
                    F.when(F.col("detail_lag") > 0,
                           F.concat(F.lit(" ("), F.col("detail_lag").cast("string"), F.lit(" day"),
                                    F.when(F.col("detail_lag") == 1, "").otherwise("s"),
                                    F.lit(" behind)")))
                    .otherwise(F.lit("")).alias("lag_text")))


# --- ledger cube and billed sections -------------------------------------------
def ledger_cube(ledger: DataFrame, family: ServiceFamily, w: ReportWindow) -> DataFrame:
    """(day, service_type, name) → credits over [min(month start, week start),
    report day], family members only."""
    return (ledger.filter(_day_range("start_time", w.lo, w.report_day)
                          & family.contains("service_type"))
            .groupBy(F.to_date("start_time").alias("day"), "service_type", "name")
            .agg(F.sum("credits_used").cast(CREDITS).alias("credits")))


def _in(day: str, lo, hi) -> Column:
    if lo is None or hi is None:
        return F.lit(False)
    return F.col(day).between(F.lit(lo), F.lit(hi))


def _usd(credits: str, price: str | Decimal) -> Column:
    """Credits times price, rounded once, to cents.

    The product keeps every digit: credits get the 38 digits the price leaves.  More
    credits than that fail under ANSI mode instead of losing digits."""
    d = Decimal(str(price))
    if not d.is_finite():
        raise ValueError(f"price {price!r} is not a finite number")
    scale = max(0, -d.as_tuple().exponent)
    digits = max(len(d.as_tuple().digits) + max(0, d.as_tuple().exponent), scale + 1)
    left = 37 - digits
    if left < 12:
        raise ValueError(f"price {price!r} has too many digits for exact money")
    exact = F.col(credits).cast(f"decimal({left},9)") * F.lit(format(d, "f")).cast(f"decimal({digits},{scale})")
    return exact.cast(USD)


def billed_totals(cube: DataFrame, w: ReportWindow, price) -> DataFrame:
    """Latest settled day and month-to-date, credits and money (one pass)."""
    zero = F.lit(0).cast(CREDITS)
    t = cube.agg(
        F.coalesce(F.sum(F.when(_in("day", w.report_day, w.report_day), F.col("credits"))), zero)
        .cast(CREDITS).alias("day_credits"),
        F.coalesce(F.sum(F.when(_in("day", w.m_start, w.report_day), F.col("credits"))), zero)
        .cast(CREDITS).alias("mtd_credits"))
    return t.select("day_credits", _usd("day_credits", price).alias("day_usd"),
                    "mtd_credits", _usd("mtd_credits", price).alias("mtd_usd"))


def known_types_frame(spark: SparkSession, known: str) -> DataFrame:
    """The configured comma list as rows (``explode(split)`` + trim)."""
    return (spark.range(1).select(F.explode(F.split(F.lit(known), ",")).alias("t"))
            .select(F.trim("t").alias("service_type")))


def new_service_types(cube: DataFrame, w: ReportWindow, known: DataFrame) -> DataFrame:
    """Family members billed this month that are not in the known list, as
    one sorted, comma-separated string (NULL when there are none)."""
    kn = known.filter(F.col("service_type").isNotNull())
    # the known list is a settings value: its size is bounded by the settings
    m = cube.filter(_in("day", w.m_start, w.report_day)).select("service_type")
    new = m.join(F.broadcast(kn), "service_type", "left_anti")
    return new.agg(F.expr(
        "listagg(DISTINCT service_type, ', ') WITHIN GROUP (ORDER BY service_type)").alias("new_types"))


def budget_status(billed: DataFrame, budget: float, warn_pct: float) -> DataFrame:
    """Month-to-date against the budget; no row when the budget is ≤ 0."""
    if budget is None or budget <= 0:
        return billed.limit(0).select(
            F.col("mtd_credits"), F.lit(None).cast("double").alias("budget_credits"),
            F.lit(None).cast("string").alias("budget_pct_text"),
            F.lit(None).cast("string").alias("status"))
    pct = F.col("mtd_credits").cast("double") * F.lit(100.0) / F.lit(float(budget))
    return billed.select(
        "mtd_credits", F.lit(float(budget)).alias("budget_credits"),
        F.round(pct.cast("decimal(38,9)"), 1).cast("decimal(38,1)").cast("string")
        .alias("budget_pct_text"),
        F.when(pct >= 100, "OVER BUDGET").when(pct >= F.lit(float(warn_pct)), "WARN")
        .otherwise("OK").alias("status"))


def usage_by_type(cube: DataFrame, w: ReportWindow, labels: ServiceLabels, price) -> DataFrame:
    """Month-to-date credits per service type; types with credits ≤ 0 are left
    out (so with adjustments the rows need not foot to the total)."""
    g = (cube.filter(_in("day", w.m_start, w.report_day))
         .groupBy("service_type").agg(F.sum("credits").cast(CREDITS).alias("credits"))
         .filter(F.col("credits") > 0))
    return g.select("service_type", labels.label("service_type").alias("type_label"),
                    "credits", _usd("credits", price).alias("usd"))


def usage_by_type_subtype(cube: DataFrame, w: ReportWindow, labels: ServiceLabels,
                          n: int, price) -> DataFrame:
    """Top ``n`` (type label, subtype) pairs + Others, month to date."""
    g = (cube.filter(_in("day", w.m_start, w.report_day))
         .groupBy(labels.label("service_type").alias("type_label"),
                  F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit("—")).alias("subtype"))
         .agg(F.sum("credits").cast(CREDITS).alias("credits")))
    t = top_n_with_others(g, ["type_label", "subtype"], "credits", n,
                          {"type_label": "Others", "subtype": "(remaining subtypes)"})
    return t.withColumn("usd", _usd("credits", price))


def daily_trend(cube: DataFrame, w: ReportWindow, price) -> DataFrame:
    """Credits per day over the 7-day window (days with rows only)."""
    g = (cube.filter(_in("day", w.wk_start, w.report_day))
         .groupBy("day").agg(F.sum("credits").cast(CREDITS).alias("credits")))
    return g.withColumn("usd", _usd("credits", price))


# --- detail cube and drill-downs ----------------------------------------------------
def detail_cube(raw: DataFrame, users: DataFrame, w: ReportWindow) -> DataFrame:
    """Month-to-date detail credits per (service, function, model, agent,
    user) with the user name resolved after the aggregation."""
    g = (raw.filter(_day_range("usage_time", w.m_start, w.report_day))
         .groupBy("service", "function_name", "model_name", "agent_name",
                  "user_id", "user_name_raw")
         .agg(F.sum("credits").cast(CREDITS).alias("credits")))
    return (g.join(users_dedup(users), "user_id", "left")
            .select("service", "function_name", "model_name", "agent_name",
                    resolve_user().alias("user_name"), "credits"))


def detail_totals(raw: DataFrame, w: ReportWindow, price) -> DataFrame:
    """Month-to-date detail credits, money and distinct request count."""
    t = (raw.filter(_day_range("usage_time", w.m_start, w.report_day))
         .agg(F.coalesce(F.sum("credits"), F.lit(0).cast(CREDITS)).cast(CREDITS).alias("credits"),
              F.countDistinct("usage_id").alias("requests")))
    return t.select("credits", _usd("credits", price).alias("usd"), "requests")


def model_kind() -> Column:
    return (F.when(F.col("model_name").isNotNull(), "Model")
            .when(F.col("agent_name").isNotNull(), "Agent").otherwise("Service"))


def detail_groups(dcube: DataFrame) -> DataFrame:
    """(cut, label, kind, credits): the detail cube by function, by model (else agent, else
    service, with its kind) and by user, in one aggregate over it."""
    def cut(name: str, label: Column, kind: Column) -> Column:
        return F.struct(F.lit(name).alias("cut"), label.alias("label"), kind.alias("kind"))

    cuts = F.array(
        cut("function", F.coalesce("function_name", F.lit("(none)")), F.lit("")),
        cut("model", F.coalesce("model_name", "agent_name", "service"), model_kind()),
        cut("user", F.col("user_name"), F.lit("")))
    return (dcube.select(F.explode(cuts).alias("g"), "credits")
            .groupBy("g.cut", "g.label", "g.kind").agg(F.sum("credits").cast(CREDITS).alias("credits")))


def _drill(groups: DataFrame, cut: str, labels: dict[str, str], n: int, others: dict, price) -> DataFrame:
    """Top ``n`` + Others of one cut; ``labels``: output name by group column."""
    g = groups.filter(F.col("cut") == cut).select(
        *[F.col(c).alias(name) for c, name in labels.items()], "credits")
    t = top_n_with_others(g, list(labels.values()), "credits", n, others)
    return t.withColumn("usd", _usd("credits", price))


def usage_by_function(groups: DataFrame, n: int, price) -> DataFrame:
    return _drill(groups, "function", {"label": "function_name"}, n, {"function_name": "Others"}, price)


def usage_by_model(groups: DataFrame, n: int, price) -> DataFrame:
    """By model, else agent, else service name, tagged with its kind."""
    return _drill(groups, "model", {"label": "name", "kind": "kind"}, n, {"name": "Others", "kind": ""}, price)


def usage_by_user(groups: DataFrame, n: int, price) -> DataFrame:
    return _drill(groups, "user", {"label": "user_name"}, n, {"user_name": "Others"}, price)


def usage_by_user_function(dcube: DataFrame, n: int, price) -> DataFrame:
    """Every user's own sub-table: top ``n`` functions + Others, month to date."""
    g = (dcube.groupBy("user_name", F.coalesce("function_name", F.lit("(none)")).alias("function_name"))
         .agg(F.sum("credits").cast(CREDITS).alias("credits")))
    t = top_n_within(g, ["user_name"], ["function_name"], "credits", n, {"function_name": "Others"})
    return t.withColumn("usd", _usd("credits", price))


# --- over days, rates and cost centres -----------------------------------------------
def daily_delta(cube: DataFrame, w: ReportWindow) -> DataFrame:
    """(day, service_type, credits, previous, delta) for every type and every day from its first
    in the cube to the report day; days without rows count as zero, a first day has no
    previous one.  The calendar is a sequence per type, so it grows with types and days only."""
    sums = cube.groupBy("service_type", "day").agg(F.sum("credits").cast(CREDITS).alias("credits"))
    last = F.lit(w.report_day).cast("date")
    calendar = (sums.groupBy("service_type").agg(F.min("day").alias("first"))
                .select("service_type", F.explode(F.sequence("first", last)).alias("day")))
    dense = (calendar.join(sums.withColumnsRenamed({"service_type": "s", "day": "d"}),
                           F.col("service_type").eqNullSafe(F.col("s")) & (F.col("day") == F.col("d")), "left")
             .select("day", "service_type", F.coalesce("credits", F.lit(0)).cast(CREDITS).alias("credits")))
    previous = F.lag("credits").over(Window.partitionBy("service_type").orderBy("day"))
    return (dense.withColumn("previous", previous)
            .withColumn("delta", (F.col("credits") - F.col("previous")).cast(CREDITS)))


def billed_at_rates(ledger: DataFrame, rates: DataFrame, width_days: float = 1.0) -> DataFrame:
    """(service_type, price, n_rows, credits, usd): every ledger row at the rate of its type that
    was in force at its time (``rates``: service_type, valid_from, price).  Rows before a
    type's first rate have no price and no money.  Money is exact, rounded once per price."""
    priced = as_of_join(ledger.select("service_type", "start_time", "credits_used"), rates, ["service_type"],
                        "start_time", "valid_from", ["price"], width_days)
    g = priced.groupBy("service_type", "price").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("credits_used").cast(CREDITS).alias("credits"))
    money = (F.col("credits").cast("decimal(28,9)") * F.col("price").cast("decimal(9,4)")).cast(USD)
    return g.select("service_type", "price", "n_rows", "credits", money.alias("usd"))


NO_CENTRE = "(none)"


def cost_centres(cube: DataFrame, centres: DataFrame, w: ReportWindow, price) -> DataFrame:
    """(level, division, centre, credits, usd): month-to-date credits by cost centre, with totals by
    division (level 1) and of all (level 3), from one rollup.  ``centres``: name, valid_from,
    centre, division; a name counts for the centre it belonged to on the day."""
    mtd = (cube.filter(_in("day", w.m_start, w.report_day))
           .groupBy("day", "name").agg(F.sum("credits").cast(CREDITS).alias("credits")))
    placed = as_of_join(mtd, centres, ["name"], "day", "valid_from", ["division", "centre"], 31)
    named = placed.select(*[F.coalesce(c, F.lit(NO_CENTRE)).alias(c) for c in ("division", "centre")], "credits")
    g = named.rollup("division", "centre").agg(F.grouping_id().cast("int").alias("level"),
                                               F.sum("credits").cast(CREDITS).alias("credits"))
    credits = F.coalesce("credits", F.lit(0)).cast(CREDITS)
    return (g.withColumn("credits", credits)
            .select("level", "division", "centre", "credits", _usd("credits", price).alias("usd")))


# --- verify queries ---------------------------------------------------------------
def usage_profile(raw: DataFrame) -> DataFrame:
    """All-time row count, credits (2 dp), first and last request."""
    return raw.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.round(F.sum("credits"), 2).cast("decimal(38,2)").alias("total_credits"),
                   F.min("usage_time").alias("first_seen"),
                   F.max("usage_time").alias("last_seen"))


def mtd_by_service(raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    """From the first of ``as_of``'s month on (no upper bound)."""
    start = dt.datetime(as_of.year, as_of.month, 1)
    return (raw.filter(F.col("usage_time") >= ts_lit(start))
            .groupBy("service")
            .agg(F.round(F.sum("credits"), 4).cast("decimal(38,4)").alias("credits"),
                 F.countDistinct("usage_id").alias("queries")))


# --- reconciliation ------------------------------------------------------------------
def reconcile(sections: dict[str, DataFrame], billed: DataFrame, detail: DataFrame) -> DataFrame:
    """(section, listed_sum, total, diff): billed sections foot to the billed
    month-to-date, drill-downs to the detail month-to-date.  One aggregate over all
    sections' rows and both totals."""
    def tagged(name: str, df: DataFrame, column: str) -> DataFrame:
        return df.select(F.lit(name).alias("section"), F.col(column).cast(CREDITS).alias("credits"))

    parts = [tagged(name, df, "credits") for name, df in sections.items()]
    parts += [tagged("billed", billed, "mtd_credits"), tagged("detail", detail, "credits")]
    rows = reduce(DataFrame.unionByName, parts)

    def total(name: str) -> Column:
        s = F.sum(F.when(F.col("section") == name, F.col("credits")))
        return F.coalesce(s, F.lit(0).cast(CREDITS)).cast(CREDITS)

    one = rows.agg(*[total(n).alias(n) for n in [*sections, "billed", "detail"]])
    lines = [F.struct(F.lit(n).alias("section"), F.col(n).alias("listed_sum"),
                      F.col("billed" if n in ("usage_by_type", "usage_by_type_subtype") else "detail")
                      .alias("total")) for n in sections]
    return (one.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
            .withColumn("diff", (F.col("listed_sum") - F.col("total")).cast(CREDITS)))


# --- one report's inputs ---------------------------------------------------------------
@dataclass
class UsageInputs:
    """Ledger, daily ledger, detail logs, user dimension and the run time
    (UTC wall clock; defaults to now, so the report covers the latest
    settled day before today).  A report reads each of them when a section first needs it,
    so an object that opens its tables on first use serves as well."""
    ledger: DataFrame
    ledger_days: DataFrame
    logs: list[UsageLog]
    users: DataFrame
    as_of: dt.datetime | None = None

    def __post_init__(self):
        if self.as_of is None:
            self.as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _memo(fn):
    """Build a report part once per report (the plan, not its result)."""
    def wrapper(self):
        parts = self.__dict__.setdefault("_parts", {})
        if fn.__name__ not in parts:
            parts[fn.__name__] = fn(self)
        return parts[fn.__name__]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


class IncompleteRollup(ValueError):
    """A maintained cube that lacks days of the reporting window."""


class UsageReport:
    """All sections of one report, sharing the window and the two cubes.

    ``write_cubes=True`` computes the ledger cube, the drill-down groups (from the detail
    cube) and the detail totals once, into the shared folder (``spark.checkpoint.dir``); every section then reads these
    few rows, and a lost executor costs no scan.  Without it every section is a lazy plan
    over the inputs, which is best for a single section.
    """

    def __init__(self, spark: SparkSession, inputs: UsageInputs,
                 settings: ReportSettings, write_cubes: bool = False,
                 rollup: DataFrame | None = None):
        """``rollup``: a maintained (day, service_type, name, credits) table, e.g. what
        :func:`martlight.streaming.ledger_rollup.read_cube` reads, used instead of the raw
        ledger.  Days of the window that it lacks raise :class:`IncompleteRollup`."""
        self.spark = spark
        self.inp = inputs
        self.s = settings
        self.window = reporting_window(inputs.ledger_days, inputs.as_of)
        self.rollup = rollup
        if rollup is not None:
            self._check(rollup)
        if write_cubes:
            # three independent jobs, submitted side by side
            with ThreadPoolExecutor(3) as pool:
                cube, groups, totals = pool.map(written, (self.cube, self.groups, self.detail()),
                                                ("ledger-cube", "detail-groups", "detail-totals"))
            self._parts |= {"cube": cube, "groups": groups, "detail": totals}

    def _check(self, rollup: DataFrame) -> None:
        w = self.window
        mine = rollup.filter(_in("day", w.lo, w.report_day))
        lacking = (self.inp.ledger_days.filter(_in("usage_date", w.lo, w.report_day))
                   .select(F.col("usage_date").alias("day")).distinct()
                   .join(mine.select("day").distinct(), "day", "left_anti"))
        days = sorted(r["day"].isoformat() for r in lacking.collect())   # of one window
        if days:
            raise IncompleteRollup(f"the rollup lacks {', '.join(days)}")

    # parts are planned when a section first needs them
    @property
    @_memo
    def raw(self):
        return unify_raw(self.inp.logs)

    @property
    @_memo
    def cube(self):
        w = self.window
        if self.rollup is None:
            return ledger_cube(self.inp.ledger, self.s.family, w)
        return (self.rollup.filter(_in("day", w.lo, w.report_day) & self.s.family.contains("service_type"))
                .groupBy("day", "service_type", "name").agg(F.sum("credits").cast(CREDITS).alias("credits")))

    @property
    @_memo
    def dcube(self):
        return detail_cube(self.raw, self.inp.users, self.window)

    @property
    @_memo
    def groups(self):
        return detail_groups(self.dcube)

    @property
    def price(self):
        return self.s.credit_price

    @_memo
    def billed(self):
        return billed_totals(self.cube, self.window, self.price)

    @_memo
    def detail(self):
        return detail_totals(self.raw, self.window, self.price)

    @_memo
    def currency(self):
        return detail_currency(self.raw, self.window)

    @_memo
    def new_types(self):
        return new_service_types(self.cube, self.window,
                                 known_types_frame(self.spark, self.s.known_types))

    @_memo
    def budget(self):
        return budget_status(self.billed(), self.s.budget, self.s.warn_pct)

    @_memo
    def by_type(self):
        return usage_by_type(self.cube, self.window, self.s.labels, self.price)

    @_memo
    def by_type_subtype(self):
        return usage_by_type_subtype(self.cube, self.window, self.s.labels,
                                     self.s.subtype_top_n, self.price)

    @_memo
    def trend(self):
        return daily_trend(self.cube, self.window, self.price)

    @_memo
    def by_function(self):
        return usage_by_function(self.groups, self.s.top_n, self.price)

    @_memo
    def by_model(self):
        return usage_by_model(self.groups, self.s.top_n, self.price)

    @_memo
    def by_user(self):
        return usage_by_user(self.groups, self.s.top_n, self.price)

    @_memo
    def reconcile(self):
        return reconcile({"usage_by_type": self.by_type(),
                          "usage_by_type_subtype": self.by_type_subtype(),
                          "usage_by_function": self.by_function(),
                          "usage_by_model": self.by_model(),
                          "usage_by_user": self.by_user()},
                         self.billed(), self.detail())
