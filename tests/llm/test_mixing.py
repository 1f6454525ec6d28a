"""Mixing: targets, copies, sums near targets, DuckDB SQL, awkward rows."""
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlight.llm import mixing, queries
from tests.llm.common import SF, WORD, awkward, empty, rows


def plain_targets(sizes):
    """Reshare the excess by weight until no source is above its ceiling."""
    w = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    total, fixed = sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        if not open_:
            return [fixed[i] for i in range(len(sizes))]
        left, share = total - sum(fixed.values()), sum(w[i] for i in open_)
        aim = {i: Fraction(left * w[i], share) for i in open_}
        over = [i for i in open_ if aim[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, aim.get(i)) for i in range(len(sizes))]
        fixed |= {i: Fraction(3 * sizes[i]) for i in over}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=12))
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", False, s) for i, s in enumerate(sizes)],
                               "sk string, no_source boolean, source_size long")
    got = {r["sk"]: r["target"] for r in mixing.targets(df).collect()}
    for i, want in enumerate(plain_targets(sizes)):
        assert got[f"s{i:02d}"] == pytest.approx(float(want), rel=1e-12, abs=1e-9)


def check(out, sizes):
    """out: (doc_id, size, source_size, target, taken); sizes by source in order."""
    assert all(t <= 3 * s and (s == 0 or t % s == 0) for _, s, _, _, t in out)
    by = {}
    for _, s, total, target, taken in out:
        by.setdefault((total, target), []).append((s, taken))
    for (total, target), x in by.items():
        assert abs(sum(t for _, t in x) - target) <= 4 * max(s for s, _ in x)


def test_query_equals_sql_and_comes_near_targets(spark):
    import duckdb
    got = rows(queries.op5_mixing(spark, SF).select("doc_id", "size", "source_size", "target", "taken"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(got) == sorted(con.execute(
        f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.oracle_sql()})").fetchall())
    check(got, None)
    assert sorted(got) == sorted(rows(queries.op5_mixing(spark, SF)))         # reruns agree


def test_awkward_rows(spark):
    df = awkward(spark)
    out = rows(mixing.report(df))
    assert sorted(r[1] for r in out) == sorted(len(WORD.findall(r["text"] or "")) for r in df.collect())
    order = ["a", "b", "c", "Ünicode", None]
    total = {s: sum(len(WORD.findall(r["text"] or "")) for r in df.collect() if r["source"] == s) for s in order}
    want = dict(zip((total[s] for s in order), map(float, plain_targets([total[s] for s in order]))))
    assert {r[2]: r[3] for r in out} == pytest.approx(want)
    check([r for r in out if r[2] > 50], None)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    counts = {}
    for r in mixed.collect():
        counts[r["doc_id"], r["source"]] = counts.get((r["doc_id"], r["source"]), 0) + 1
    words = sum(r[4] for r in out)
    assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == words


def test_a_hot_source_is_sampled_evenly(spark):
    from pyspark.sql import functions as F
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"),
                                  F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
                                      F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    out = rows(mixing.report(df))
    taken, aim = {}, {}
    for d, _, _, target, n in out:
        source = "hot" if d % 3 == 0 else f"s{d % 7}"
        taken[source] = taken.get(source, 0) + n
        aim[source] = target
    assert all(abs(taken[s] - aim[s]) <= 3 for s in aim) and len(aim) == 8


def test_empty_and_wordless_tables(spark):
    assert rows(mixing.report(empty(spark))) == [] and rows(mixing.mix(empty(spark))) == []
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(rows(mixing.report(df))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_size_classes_are_monotonous(spark):
    df = spark.range(0, 70_000)
    got = [r[0] for r in df.select(mixing._size_class(df["id"])).collect()]
    assert got == sorted(got) and len(set(got)) < 600
