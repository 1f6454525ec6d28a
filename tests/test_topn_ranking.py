import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlight.operators.ranking import global_row_number
from martlight.operators.topn import SENTINEL_RANK, top_n_with_others


def _groups(spark, pairs):
    return spark.createDataFrame([(k, Decimal(v) if v is not None else None) for k, v in pairs],
                                 "lbl string, cr decimal(38,9)")


@pytest.mark.parametrize("n_groups,expect_others", [(2, False), (3, False), (4, True), (9, True)])
def test_others_only_beyond_n(spark, n_groups, expect_others):
    g = _groups(spark, [(f"g{i}", str(i)) for i in range(n_groups)])
    out = top_n_with_others(g, ["lbl"], "cr", 3, {"lbl": "Others"}).collect()
    ranks = sorted(r["sort_rn"] for r in out)
    assert (SENTINEL_RANK in ranks) == expect_others
    assert sum(r["cr"] for r in out) == sum(Decimal(i) for i in range(n_groups))
    assert len(out) == min(n_groups, 3) + (1 if expect_others else 0)


def test_ties_break_by_label_and_nulls_rank_first(spark):
    g = _groups(spark, [("b", "5"), ("a", "5"), ("c", "7"), ("z", None), ("d", "1")])
    out = top_n_with_others(g, ["lbl"], "cr", 3, {"lbl": "Others"}).orderBy("sort_rn").collect()
    assert [(r["sort_rn"], r["lbl"]) for r in out] == [(1, "z"), (2, "c"), (3, "a"),
                                                       (SENTINEL_RANK, "Others")]
    assert out[-1]["cr"] == Decimal(6)            # b(5) + d(1)


def test_two_labels_and_single_folded_group(spark):
    g = spark.createDataFrame([("T", "x", Decimal(3)), ("T", "y", Decimal(2)), ("U", "x", Decimal("0.0001"))],
                              "t string, s string, cr decimal(38,9)")
    out = top_n_with_others(g, ["t", "s"], "cr", 2, {"t": "Others", "s": "(rest)"}).collect()
    other = [r for r in out if r["sort_rn"] == SENTINEL_RANK][0]
    assert (other["t"], other["s"], other["cr"]) == ("Others", "(rest)", Decimal("0.0001"))


@pytest.mark.parametrize("partitions", [1, 3, 8, 64])
def test_global_row_number_matches_window(spark, partitions):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), f"u{i:04d}", rnd.choice([None, 1.5, 2.5])) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, u string, x double").repartition(5)
    got = global_row_number(df, ["a", "u"], [True, False], "rn", partitions=partitions)
    exp = df.withColumn("rn2", F.row_number().over(
        Window.orderBy(F.col("a").desc_nulls_first(), F.col("u").asc())))
    j = got.join(exp, ["a", "u"])
    assert j.count() == 3000
    assert j.filter("rn <> rn2").count() == 0
    assert sorted(r["rn"] for r in got.select("rn").collect()) == list(range(1, 3001))


def test_global_row_number_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert global_row_number(df, ["a"]).count() == 0


def test_others_exact_at_full_scale(spark):
    vals = ["0.000000001", "123456789.123456789", "0.000000003", "5.555555555", "-0.000000002"]
    g = _groups(spark, [(f"g{i}", v) for i, v in enumerate(vals)])
    out = top_n_with_others(g, ["lbl"], "cr", 2, {"lbl": "Others"}).collect()
    other = [r for r in out if r["sort_rn"] == SENTINEL_RANK][0]
    assert other["cr"] == Decimal("0.000000002")
    assert sum(r["cr"] for r in out) == sum(Decimal(v) for v in vals)


def test_others_floating_values(spark):
    g = spark.createDataFrame([("a", 1.5), ("b", 0.25), ("c", 0.125)], "lbl string, cr double")
    out = top_n_with_others(g, ["lbl"], "cr", 1, {"lbl": "Others"}).collect()
    assert sorted((r["sort_rn"], r["lbl"], r["cr"]) for r in out) == [(1, "a", 1.5), (SENTINEL_RANK, "Others", 0.375)]


def test_global_row_number_wall_clock_keys(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), i) for i in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, i int").repartition(4)
    got = {r["i"]: r["rn"] for r in global_row_number(df, ["ts"], name="rn", partitions=6).collect()}
    assert got == {i: i + 1 for i in range(500)}


def test_global_row_number_orders_as_spark_does(spark):
    import sys
    nan, big = float("nan"), -(2 ** 63)
    rows = [(1, nan, big), (2, None, None), (3, 1.5, 0), (4, -2.0, 2 ** 63 - 1), (5, float("inf"), big + 1)]
    df = spark.createDataFrame(rows, "i int, x double, b bigint")
    for keys, desc in ((["x", "i"], [True, False]), (["x", "i"], [False, True]), (["b", "i"], [True, False]),
                       (["b", "i"], [False, False])):
        order = [F.col(k).desc_nulls_first() if d else F.col(k).asc_nulls_first() for k, d in zip(keys, desc)]
        want = {r["i"]: r["n"] for r in df.withColumn("n", F.row_number().over(Window.orderBy(*order))).collect()}
        got = {r["i"]: r["rn"] for r in global_row_number(df, keys, desc, partitions=4).collect()}
        assert got == want, (keys, desc, sys.version)


def test_global_row_number_with_two_thousand_partitions(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("a"), "id")
    got = global_row_number(df, ["a", "id"], partitions=2000)
    assert got.agg(F.max("rn"), F.countDistinct("rn")).first()[:] == (40_000, 40_000)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
