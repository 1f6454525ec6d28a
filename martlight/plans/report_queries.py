"""Report-rendering queries over the bound testdata."""

from __future__ import annotations

from martlight.catalog import register
from martlight.oracle import usage_sql as Q
from martlight.plans import report
from martlight.plans.usage_queries import demo_report


@register("report_subject", Q.REPORT_SUBJECT)
def _subject(spark, sf_dir):
    return report.report_subject(demo_report(spark, sf_dir))


@register("report_sections", Q.REPORT_SECTIONS)
def _sections(spark, sf_dir):
    return report.report_sections(demo_report(spark, sf_dir, write_cubes=True))


@register("report_html", Q.REPORT_HTML)
def _html(spark, sf_dir):
    """The assembled report, one row (subject, body)."""
    return report.report_html(demo_report(spark, sf_dir, write_cubes=True))
