import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlight.operators.settings import ReportSettings
from martlight.plans.usage import IncompleteRollup, UsageReport
from martlight.plans.usage_queries import demo_inputs
from martlight.streaming.ledger_rollup import incomplete_days, ledger_rollup, read_cube, start_rollup
from tests.conftest import SF_SMALL

PARTS = ("billed", "by_type", "by_type_subtype", "trend", "new_types")


def same(x, y):
    return x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def stream(spark, src, schema, out, ckpt, **kw):
    q = start_rollup(spark, src, schema, out, checkpoint=ckpt, **kw)
    q.awaitTermination(300)
    assert q.exception() is None


def test_streamed_cube_and_its_report_equal_the_ledgers(spark):
    base = tempfile.mkdtemp(prefix="martlight-stream-")
    src, out, ckpt = (os.path.join(base, x) for x in ("ledger", "cube", "ckpt"))
    inp = demo_inputs(spark, SF_SMALL)
    # land the ledger as several files, one per week, as a feed would
    (inp.ledger.withColumn("wk", F.weekofyear("start_time")).repartition("wk").drop("wk")
     .write.parquet(src))
    stream(spark, src, inp.ledger.schema, out, ckpt, max_files_per_trigger=1)
    cube = read_cube(spark, out)
    assert same(cube, ledger_rollup(inp.ledger))
    s = ReportSettings.defaults()
    a, b = UsageReport(spark, inp, s), UsageReport(spark, inp, s, rollup=cube)
    for part in PARTS:
        assert same(getattr(a, part)(), getattr(b, part)()), part
    day = a.window.report_day
    assert read_cube(spark, out, day, day).select("day").distinct().count() == 1
    with pytest.raises(IncompleteRollup, match=day.isoformat()):
        UsageReport(spark, inp, s, rollup=cube.where(F.col("day") < F.lit(day)))


def test_late_rows_count_for_their_day_and_reruns_count_once(spark):
    base = tempfile.mkdtemp(prefix="martlight-late-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "cube", "ckpt"))
    schema = "service_type string, name string, start_time timestamp_ntz, credits_used decimal(28,9)"
    T = dt.datetime

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream(spark, src, spark.read.parquet(src).schema, out, ckpt)

    land([("web.click", "a", T(2026, 6, 1, 10), Decimal(1)), ("web.click", "a", T(2026, 6, 2, 10), Decimal(2))])
    land([("web.click", "a", T(2026, 6, 9, 23), Decimal(10)), ("batch.job", None, T(2026, 6, 5, 10), Decimal(5))])
    land([("web.click", "a", T(2026, 6, 1, 12), Decimal(100))])          # eight days late
    got = {(r["day"].day, r["service_type"]): r["credits"] for r in read_cube(spark, out).collect()}
    assert got == {(1, "web.click"): 101, (2, "web.click"): 2, (9, "web.click"): 10, (5, "batch.job"): 5}
    # a batch that runs again overwrites its folder
    one = spark.read.parquet(src).where("credits_used = 100")
    ledger_rollup(one).write.mode("overwrite").partitionBy("day").parquet(f"{out}/batch=2")
    assert sum(r["credits"] for r in read_cube(spark, out).collect()) == 118


def test_days_with_files_still_to_come_are_known(spark):
    base = tempfile.mkdtemp(prefix="martlight-days-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "cube", "ckpt"))
    schema = "service_type string, name string, start_time timestamp_ntz, credits_used decimal(28,9)"
    T = dt.datetime

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        return spark.read.parquet(src).schema

    def waiting(**kw):
        return sorted((r["day"].day, r["rows"], r["files"]) for r in incomplete_days(spark, src, s, out, **kw).collect())

    s = land([("web.click", "a", T(2026, 6, 1, 10), Decimal(1)), ("web.click", "a", T(2026, 6, 2, 10), Decimal(2))])
    assert waiting() == [(1, 1, 1), (2, 1, 1)]                   # before the first batch
    stream(spark, src, s, out, ckpt)
    assert waiting() == []
    # the second file of a day that the cube already holds
    land([("web.click", "b", T(2026, 6, 2, 23), Decimal(4)), ("web.click", "b", T(2026, 6, 2, 22), Decimal(4))])
    assert waiting() == [(2, 2, 1)] and waiting(hi=dt.date(2026, 6, 1)) == []
    stream(spark, src, s, out, ckpt)
    assert waiting() == [] and sum(r["credits"] for r in read_cube(spark, out).collect()) == 11
