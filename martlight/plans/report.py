"""Rendering the usage report: subject line, per-section HTML rows, and the
assembled body.

Every section is bounded before it is rendered (top-N + Others, a handful
of service types, seven trend days), so each ordered ``listagg`` gathers at
most a few dozen short strings into one value.  The body is a concat over
one-row frames combined side by side (``operators.frames.one_row``); nothing passes through the driver except the
three window dates and the settings, which are already scalars.

Labels are HTML-escaped (``& < >``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions import formatting as fmt
from martlight.operators.frames import one_row
from martlight.operators.topn import SENTINEL_RANK
from martlight.plans.usage import UsageReport

NO_ROWS = "<p><i>No activity.</i></p>"

# The report's sentences (also read by the oracle, which lays them out by itself).
TEXT = {
    "title": "<h2>Usage</h2><p>Credits by day, type and user. Days are UTC days.</p>",
    "unreviewed": '<div class="guard"><b>Not yet reviewed:</b> ',
    "unreviewed_end": " &ndash; included in every sum; add to known_types once reviewed.</div>",
    "legend": "<p>Two dates appear in this report.</p>",
    "legend_ledger": " The ledger is final up to this day. Totals and types come from it.",
    "legend_detail": " Request logs reach this day. They arrive after the ledger, so the "
                     "drill-downs may add up to less than was billed.",
    "band_billed": '<div class="band">Billed credits</div>',
    "band_detail": '<div class="band">Request logs</div>',
    "band_trend": '<div class="band">Week</div>',
    "note_type": "<p>Types with credits above zero this month.</p>",
    "note_subtype": "<p>A subtype is the name credits were metered under. Rows listed: ",
    "note_model": "<p>The model of a click, the agent or campaign of a view or sign-up, "
                  "otherwise the service.</p>",
}


def _td(x: Column, right: bool = False) -> Column:
    return F.concat(F.lit('<td align="right">' if right else "<td>"), x, F.lit("</td>"))


def _tr(cells: list[Column], others: Column | None = None) -> Column:
    open_ = F.lit("<tr>") if others is None else \
        F.when(others, F.lit('<tr class="others">')).otherwise(F.lit("<tr>"))
    return F.concat(open_, *cells, F.lit("</tr>"))


def _money_cells() -> list[Column]:
    return [_td(fmt.fmt_credits("credits"), True), _td(fmt.fmt_usd("usd"), True)]


def _rows(df: DataFrame, row: Column, order: str, section: str) -> DataFrame:
    return df.select(row.alias("row_html"), "*").agg(
        F.lit(section).alias("section"),
        F.count(F.lit(1)).alias("n_rows"),
        F.expr(f"listagg(row_html, '') WITHIN GROUP (ORDER BY {order})").alias("rows_html"))


def section_rows(r: UsageReport) -> dict[str, DataFrame]:
    """section → one row (section, n_rows, rows_html)."""
    esc = fmt.html_escape
    others = F.col("sort_rn") == SENTINEL_RANK
    return {
        "usage_by_type": _rows(
            r.by_type(), _tr([_td(esc("type_label"))] + _money_cells()),
            "credits DESC, type_label ASC", "usage_by_type"),
        "usage_by_type_subtype": _rows(
            r.by_type_subtype(),
            _tr([_td(esc("type_label")), _td(esc("subtype"))] + _money_cells(), others),
            "sort_rn", "usage_by_type_subtype"),
        "daily_trend": _rows(
            r.trend(), _tr([_td(fmt.fmt_day("day"))] + _money_cells()),
            "day DESC", "daily_trend"),
        "usage_by_function": _rows(
            r.by_function(), _tr([_td(esc("function_name"))] + _money_cells(), others),
            "sort_rn", "usage_by_function"),
        "usage_by_model": _rows(
            r.by_model(), _tr([_td(esc("name")), _td(esc("kind"))] + _money_cells(), others),
            "sort_rn", "usage_by_model"),
        "usage_by_user": _rows(
            r.by_user(), _tr([_td(esc("user_name"))] + _money_cells(), others),
            "sort_rn", "usage_by_user"),
    }


def report_sections(r: UsageReport) -> DataFrame:
    """All sections as rows (section, n_rows, rows_html)."""
    return reduce(DataFrame.unionByName, section_rows(r).values())


def report_subject(r: UsageReport) -> DataFrame:
    """``<prefix> - Fri 2024-01-19 - 1,234.56 credits ($3,703.68)``"""
    day = F.lit(r.window.report_day).cast("date")
    return r.billed().select(F.concat(
        F.lit(r.s.subject_prefix), F.lit(" - "), _or_dash(fmt.fmt_day_named(day)), F.lit(" - "),
        fmt.fmt_credits2("day_credits"), F.lit(" credits ("), fmt.fmt_usd("day_usd"),
        F.lit(")")).alias("subject"))


def _or_dash(x: Column) -> Column:
    """A missing date (no settled day yet) prints as a dash."""
    return F.coalesce(x, F.lit("—"))


def _table(head: list[str], rows: Column, footer: Column | None) -> Column:
    th = "".join(f"<th>{h}</th>" for h in head)
    parts = [F.lit(f"<table><tr>{th}</tr>"), rows]
    if footer is not None:
        parts.append(footer)
    parts.append(F.lit("</table>"))
    return F.when(F.coalesce(rows, F.lit("")) == "", F.lit(NO_ROWS)).otherwise(F.concat(*parts))


def _total_row(label_cells: int, credits: str, usd: str, label: str = "Total") -> Column:
    pad = "".join("<td></td>" for _ in range(label_cells - 1))
    return F.concat(F.lit(f'<tr class="total"><td>{label}</td>{pad}'),
                    _td(fmt.fmt_credits(credits), True), _td(fmt.fmt_usd(usd), True),
                    F.lit("</tr>"))


def report_html(r: UsageReport) -> DataFrame:
    """One row: (subject, body)."""
    w = r.window
    secs = section_rows(r)
    one = one_row(
        r.billed(),
        r.detail().select(F.col("credits").alias("d_credits"), F.col("usd").alias("d_usd"),
                          "requests"),
        r.currency(), r.new_types(), report_subject(r),
        *[df.select(F.col("rows_html").alias(f"h_{name}")) for name, df in secs.items()])
    day_text = _or_dash(fmt.fmt_day(F.lit(w.report_day)))
    settled = F.concat(F.lit('<span class="badge">settled &middot; '), day_text, F.lit("</span>"))
    detail_badge = F.concat(F.lit('<span class="badge">detail &middot; '),
                            _or_dash(fmt.fmt_day("detail_max_day")),
                            F.coalesce(F.col("lag_text"), F.lit("")), F.lit("</span>"))
    guard = F.when(F.coalesce(F.col("new_types"), F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit(TEXT["unreviewed"]), fmt.html_escape("new_types"), F.lit(TEXT["unreviewed_end"])))
    if r.s.budget is not None and r.s.budget > 0:
        pct = F.col("mtd_credits").cast("double") * F.lit(100.0) / F.lit(float(r.s.budget))
        status = (F.when(pct >= 100, "[OVER BUDGET]")
                  .when(pct >= F.lit(float(r.s.warn_pct)), "[WARN]").otherwise("[OK]"))
        budget = F.concat(
            F.lit("<h3>Budget (month to date) "), settled, F.lit("</h3><p>"),
            fmt.fmt_credits2("mtd_credits"), F.lit(" / "),
            fmt.fmt_credits2(F.lit(float(r.s.budget))), F.lit(" credits used &ndash; <b>"),
            fmt.fmt_plain(pct, 1), F.lit("%</b> "), status, F.lit("</p>"))
    else:
        budget = F.lit("")
    n_sub = r.s.subtype_top_n
    body = F.concat(
        F.lit("<html><body>" + TEXT["title"]),
        guard,
        F.lit('<div class="legend">' + TEXT["legend"] + "<div>"), settled,
        F.lit(TEXT["legend_ledger"] + "</div><div>"),
        detail_badge,
        F.lit(TEXT["legend_detail"] + "</div></div>" + TEXT["band_billed"]),
        F.lit("<h3>Latest settled day and month to date "), settled, F.lit("</h3>"),
        F.lit("<table><tr><th>Window</th><th>Credits</th><th>USD</th></tr><tr><td>Latest settled day ("),
        day_text, F.lit(")</td>"),
        _td(fmt.fmt_credits2("day_credits"), True), _td(fmt.fmt_usd("day_usd"), True),
        F.lit("</tr><tr><td>Month to date</td>"),
        _td(fmt.fmt_credits2("mtd_credits"), True), _td(fmt.fmt_usd("mtd_usd"), True),
        F.lit("</tr></table>"),
        budget,
        F.lit("<h3>By type "), settled, F.lit("</h3>" + TEXT["note_type"]),
        _table(["Service type", "Credits", "USD"], F.col("h_usage_by_type"),
               _total_row(1, "mtd_credits", "mtd_usd")),
        F.lit("<h3>By type and subtype "), settled,
        F.lit(f"</h3>{TEXT['note_subtype']}{n_sub}.</p>"),
        _table(["Type", "Subtype", "Credits", "USD"], F.col("h_usage_by_type_subtype"),
               _total_row(2, "mtd_credits", "mtd_usd")),
        F.lit(TEXT["band_detail"] + "<h3>Month to date "), detail_badge, F.lit("</h3><p>Logged: <b>"),
        fmt.fmt_credits2("d_credits"), F.lit("</b> credits; billed: "), fmt.fmt_credits2("mtd_credits"),
        F.lit(".</p><h4>By function</h4>"),
        _table(["Function", "Credits", "USD"], F.col("h_usage_by_function"),
               _total_row(1, "d_credits", "d_usd", "Total (detail)")),
        F.lit("<h4>By model or agent</h4>" + TEXT["note_model"]),
        _table(["Name", "Kind", "Credits", "USD"], F.col("h_usage_by_model"),
               _total_row(2, "d_credits", "d_usd", "Total (detail)")),
        F.lit("<h4>By user</h4>"),
        _table(["User", "Credits", "USD"], F.col("h_usage_by_user"),
               _total_row(1, "d_credits", "d_usd", "Total (detail)")),
        F.lit(TEXT["band_trend"] + "<h3>Last 7 days "), settled, F.lit("</h3>"),
        _table(["Day (UTC)", "Credits", "USD"], F.col("h_daily_trend"), None),
        F.lit(f'<p class="footer">One credit: ${r.price}.</p>'),
        F.lit("</body></html>"))
    return one.select("subject", body.alias("body"))


def build_report(r: UsageReport) -> dict[str, DataFrame]:
    """Every part of one report as a DataFrame, plus the rendered row."""
    return {
        "window": r.spark.createDataFrame(
            [(r.window.report_day, r.window.m_start, r.window.wk_start)],
            "report_day date, m_start date, wk_start date"),
        "billed_totals": r.billed(), "detail_totals": r.detail(),
        "detail_currency": r.currency(), "new_service_types": r.new_types(),
        "budget_status": r.budget(), "usage_by_type": r.by_type(),
        "usage_by_type_subtype": r.by_type_subtype(), "daily_trend": r.trend(),
        "usage_by_function": r.by_function(), "usage_by_model": r.by_model(),
        "usage_by_user": r.by_user(), "reconcile_totals": r.reconcile(),
        "report": report_html(r),
    }
