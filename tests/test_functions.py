import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martlight.functions import formatting as fmt
from martlight.functions.dates import months_between_starts
from martlight.functions.service import DEMO_FAMILY, DEMO_LABELS, ServiceFamily


def test_family_case_rules(spark):
    fam = ServiceFamily(ci_prefixes=("web.",), prefixes=("shop.",), exact=("account",))
    rows = [("web.view",), ("Web.x",), ("web.click",), ("Shop.x",), ("account",),
            ("ACCOUNT",), ("batch.job",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = {r["t"]: r["m"] for r in df.select("t", fam.contains("t").alias("m")).collect()}
    assert got == {"web.view": True, "Web.x": True, "web.click": True, "Shop.x": False,
                   "account": True, "ACCOUNT": False,
                   "batch.job": False, None: None}


def test_family_filter_drops_null(spark):
    df = spark.createDataFrame([("shop.x",), (None,)], "t string")
    assert df.filter(DEMO_FAMILY.contains("t")).count() == 1


def test_labels_pass_through(spark):
    df = spark.createDataFrame([("web.click",), ("NEW_TYPE",), (None,)], "t string")
    got = [r[0] for r in df.select(DEMO_LABELS.label("t")).collect()]
    assert got == ["Page clicks", "NEW_TYPE", None]


def test_number_formats_round_half_up(spark):
    df = spark.createDataFrame([(Decimal("2.665"),), (Decimal("1234567.12345"),), (None,),
                                (Decimal("-2.665"),)], "x decimal(20,5)")
    got = df.select(fmt.fmt_credits2("x").alias("a"), fmt.fmt_credits("x").alias("b"),
                    fmt.fmt_usd("x").alias("c"), fmt.fmt_plain("x", 1).alias("d")).collect()
    assert [tuple(r) for r in got] == [
        ("2.67", "2.6650", "$2.67", "2.7"),
        ("1,234,567.12", "1,234,567.1235", "$1,234,567.12", "1234567.1"),
        ("0.00", "0.0000", "$0.00", None),
        ("-2.67", "-2.6650", "$-2.67", "-2.7"),
    ]


def test_day_formats(spark):
    df = spark.createDataFrame([(dt.date(2026, 6, 6),)], "d date")
    r = df.select(fmt.fmt_day_named("d"), fmt.fmt_day("d")).first()
    assert tuple(r) == ("Sat 2026-06-06", "2026-06-06")


def test_html_escape(spark):
    df = spark.createDataFrame([("<b>&x",)], "s string")
    assert df.select(fmt.html_escape("s")).first()[0] == "&lt;b&gt;&amp;x"


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 31), dt.date(2025, 2, 1)),
                                (dt.date(2025, 1, 1), dt.date(2026, 6, 1))], "a date, b date")
    assert [r[0] for r in df.select(months_between_starts("a", "b")).collect()] == [1, 17]


def test_portable_draw_matches_its_sql(spark):
    import duckdb
    from martlight.operators.datagen import portable_draw, portable_draw_sql
    df = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") % 17).alias("b"))
    got = [r[0] for r in df.orderBy("a").select(portable_draw(10, 99, "a", "b", 3)).collect()]
    sql = f"select {portable_draw_sql(10, 99, 'a', 'b', 3)} from (select i as a, i % 17 as b from range(1, 300) t(i)) order by a"
    assert got == [r[0] for r in duckdb.sql(sql).fetchall()]
