"""As-of joins, top-N within groups, day-over-day deltas and cost centres on small made-up rows."""
import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlight.operators.asof import as_of_join
from martlight.operators.topn import top_n_within
from martlight.plans import usage as U

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("width", [0.01, 1, 400])
def test_as_of_equals_brute_force(spark, width):
    """A hot key, keys without right rows, equal times, rows before the first rate, nulls."""
    rng = random.Random(3)
    def at():
        return T0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 20, 30))
    left = [(i, rng.choice(["hot"] * 6 + ["a", "b", "none", None]), rng.choice([at(), at(), at(), None])) for i in range(400)]
    right = [(rng.choice(["hot", "a", "b", "x", None]), rng.choice([at(), at(), None]), rng.choice([1, 2, None]), f"v{i}")
             for i in range(60)]
    got = as_of_join(spark.createDataFrame(left, "id long, k string, ts timestamp_ntz"),
                     spark.createDataFrame(right, "k string, since timestamp_ntz, p int, q string"),
                     ["k"], "ts", "since", ["p", "q"], width)
    assert got.columns == ["id", "k", "ts", "p", "q"]

    def rank(r):
        return (r[1], -1 if r[2] is None else r[2], r[3])
    want = []
    for i, k, t in left:
        fits = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(fits, key=rank, default=(None,) * 4)
        want.append((i, k, t, best[2], best[3]))
    assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda r: r[0])


def test_as_of_shuffles_rows_once_and_by_bucket(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 9000).alias("ts"), "id")
    right = spark.range(9).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 900000).alias("since"), F.col("id").alias("p"))
    out = as_of_join(left, right, ["k"], "ts", "since", ["p"])
    assert out.count() == 1000 and out.where("p <> floor(id * 9000 / 900000)").where("p < 8").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(k0#\d+, bucket", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        as_of_join(left, right, ["k"], "ts", "since", ["k"])


def test_top_n_within_every_group(spark):
    rng = random.Random(5)
    rows = [(u, f"f{j}", rng.choice([None, Decimal(rng.randrange(50))])) for u in ("a", "b", None) for j in range(rng.randrange(2, 9))]
    rows += [("hot", f"f{j:04}", Decimal(1)) for j in range(3000)]
    df = spark.createDataFrame(rows, "u string, f string, v decimal(20,2)")
    got = top_n_within(df, ["u"], ["f"], "v", 3, {"f": "Others"})
    want = []
    for u in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == u), key=lambda r: (r[2] is not None, -(r[2] or 0), r[1]))
        want += [(u, i + 1, r[1], r[2]) for i, r in enumerate(mine[:3])]
        rest = [r[2] for r in mine[3:]]
        if rest:
            given = [v for v in rest if v is not None]
            want.append((u, 999999, "Others", sum(given) if given else None))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        str((u, i, f, None if v is None else v.quantize(Decimal("0.01")))) for u, i, f, v in want)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(TypeError):
        top_n_within(df.withColumn("v", F.col("v").cast("double")), ["u"], ["f"], "v", 3, {"f": "Others"})


WINDOW = U.ReportWindow(dt.date(2024, 3, 10), dt.date(2024, 3, 1), dt.date(2024, 3, 4))


def _cube(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 3, d), t, n, Decimal(c)) for d, t, n, c in rows],
                                 "day date, service_type string, name string, credits decimal(38,9)")


def test_daily_delta_counts_days_without_rows_as_zero(spark):
    cube = _cube(spark, [(1, "a", "x", 5), (1, "a", "y", 1), (4, "a", "x", 2), (10, "b", "x", 7)])
    got = {(r["service_type"], r["day"].day): (r["credits"], r["previous"], r["delta"])
           for r in U.daily_delta(cube, WINDOW).collect()}
    assert len(got) == 11
    assert got["a", 1] == (6, None, None) and got["a", 2] == (0, 6, -6) and got["a", 3] == (0, 0, 0)
    assert got["a", 4] == (2, 0, 2) and got["a", 10] == (0, 0, 0) and got["b", 10] == (7, None, None)


def test_cost_centres_follow_dates_and_foot_to_the_total(spark):
    cube = _cube(spark, [(1, "a", "x", 5), (5, "a", "x", 3), (5, "b", "x", 1), (6, "a", None, 2), (7, "a", "z", 4)])
    centres = spark.createDataFrame([("x", dt.date(2024, 1, 1), "c1", "d1"), ("x", dt.date(2024, 3, 5), "c2", "d1")],
                                    "name string, valid_from date, centre string, division string")
    got = {(r["level"], r["division"], r["centre"]): r["credits"] for r in U.cost_centres(cube, centres, WINDOW, "2").collect()}
    assert got == {(0, "d1", "c1"): 5, (0, "d1", "c2"): 4, (0, "(none)", "(none)"): 6, (1, "d1", None): 9,
                   (1, "(none)", None): 6, (3, None, None): 15}
    assert got[3, None, None] == U.billed_totals(cube, WINDOW, "2").first()["mtd_credits"]


def test_rows_before_the_first_rate_have_no_price(spark):
    ledger = spark.createDataFrame([("a", T0 + dt.timedelta(days=d), Decimal(d)) for d in range(1, 5)],
                                   "service_type string, start_time timestamp_ntz, credits_used decimal(28,9)")
    rates = spark.createDataFrame([("a", T0 + dt.timedelta(days=3), Decimal("2.005"))],
                                  "service_type string, valid_from timestamp_ntz, price decimal(9,4)")
    got = {r["price"]: (r["n_rows"], r["credits"], r["usd"]) for r in U.billed_at_rates(ledger, rates).collect()}
    assert got == {None: (2, 3, None), Decimal("2.0050"): (2, 7, Decimal("14.04"))}
