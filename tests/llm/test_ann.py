"""Hash-prefix forest: recall, ties, copies, vectors that take no part."""
import duckdb
import numpy as np
import pytest

from martlight.llm import ann, queries


def brute(data, is_query, k=5):
    """data: (id, vector or None); {query: [(score, id)]} of the nearest."""
    ok = {}
    for i, v in data:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = np.array(v, dtype=np.float64)
    out = {}
    for q in ok:
        if is_query(q):
            s = [(-(ok[q] @ v) / np.sqrt((ok[q] @ ok[q]) * (v @ v)), i) for i, v in ok.items()
                 if i != q and len(v) == len(ok[q])]
            out[q] = [(-round(s_, 9) + 0.0, i) for s_, i in sorted((round(a, 9), i) for a, i in s)[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((round(r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def search(spark, data, is_query=lambda i: i % 10 == 0, **args):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS vid", "2 AS h", "3 AS rank", "4 AS vector", "5 AS key")
    return lists(ann.nearest(df, "vec_id", "embedding", is_query, **args))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall_and_exact_scores(spark, sf):
    path = f"/root/testdata/{sf}"
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}/embeddings.parquet'").fetchall()
    want = brute(data, lambda i: i % 50 == 0)
    got = lists(queries.op7_ann(spark, path))
    assert set(got) == set(want) and all(len(g) == len(want[q]) for q, g in got.items())
    found = sum(len({i for _, i in g} & {i for _, i in want[q]}) for q, g in got.items())
    assert found >= 0.9 * sum(map(len, want.values()))
    v = {i: np.array(x, dtype=np.float64) for i, x in data}
    for q, g in got.items():
        for s, i in g:
            assert abs(s - v[q] @ v[i] / np.sqrt((v[q] @ v[q]) * (v[i] @ v[i]))) < 1e-8


def test_vectors_that_take_no_part_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (10, [0.0, 0.0]), (20, None), (30, [1.0, None]), (40, [nan, 1.0]), (50, [inf, 1.0]),
            (60, []), (1, [1.0, 1.0]), (2, [0.0, -1.0]), (None, [1.0, 0.0]), (70, [1.0, 2.0, 3.0]), (3, [1.0, 0.0, 0.0])]
    assert search(spark, data) == brute(data, lambda i: i % 10 == 0)


def test_copies_and_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(size=8).tolist()
    data = [(i, hot) for i in range(0, 400)] + [(i, rng.normal(size=8).tolist()) for i in range(400, 500)]
    data += [(7, hot), (450, data[450][1])]                   # repeated rows
    got = search(spark, data)
    assert got == brute(data, lambda i: i % 10 == 0)
    assert [i for _, i in got[0]] == [1, 2, 3, 4, 5] and [i for _, i in got[10]] == [0, 1, 2, 3, 4]


def test_small_buckets_and_windows_find_planted_neighbours(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    data = [(10 * i + j, (base[i] + 0.05 * rng.normal(size=16)).tolist()) for i in range(40) for j in range(6)]
    got = search(spark, data, bucket=64, window=24, candidates=48)
    hit = sum(len({i // 10 for _, i in g} & {q // 10}) and sum(i // 10 == q // 10 for _, i in g) for q, g in got.items())
    assert hit >= 0.95 * 5 * 40


def test_empty_table(spark):
    assert search(spark, []) == {} and search(spark, [(1, [1.0])]) == {}


def test_rotations_are_orthogonal_and_fixed():
    r = ann.rotation(16, 3, 1)
    assert np.allclose(r @ r.T, np.eye(16)) and (r == ann.rotation(16, 3, 1)).all()


def dense(n, group, noise, dim=16, seed=3):
    """``n`` random vectors of which the first ``group`` stand around one centre."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[:group] = rng.normal(size=dim) + noise * rng.normal(size=(group, dim))
    return x


def recall(got, x, every, k=5):
    u = x / np.sqrt((x * x).sum(1))[:, None]
    hit = 0
    for q, g in got.items():
        s = u @ u[q]
        s[q] = -2
        hit += len({i for _, i in g} & set(np.argsort(-s)[:k].tolist()))
    assert set(got) == set(range(0, len(x), every))
    return hit / (k * len(got))


def test_a_dense_group_is_visited_whole(spark):
    x = dense(6000, 2000, 0.001)
    got = search(spark, [(i, v) for i, v in enumerate(x.tolist())], lambda i: i % 100 == 0, trees=8, window=64,
                 candidates=256, bucket=128)
    assert recall({q: g for q, g in got.items() if q < 2000}, x[:2000], 100) >= 0.99


def test_results_do_not_depend_on_buckets_and_windows(spark):
    x = dense(1500, 500, 0.02)
    data = [(i, v) for i, v in enumerate(x.tolist())]
    a = search(spark, data, trees=6, candidates=64, bucket=64, window=8)
    assert a == search(spark, data, trees=6, candidates=64)


@pytest.mark.parametrize("other", [None, 0, 7])
def test_an_id_with_several_vectors_is_several_rows(spark, other):
    """A second vector under no id, under a query's and under a candidate's: rows, ranks and ties
    against brute force over rows."""
    rng = np.random.default_rng(8)
    table = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    table += [(i, (2 * np.array(v)).tolist()) for i, v in table[30:33]]           # parallel: equal scores
    if other is not None:
        table.append((other, rng.normal(size=6).tolist()))
    got = ann.nearest(spark.createDataFrame(table, "vec_id long, embedding array<double>"), "vec_id", "embedding",
                      lambda i: i % 50 == 0).collect()
    want = []
    for a, (i, v) in enumerate(table):
        if i % 50 == 0:
            v = np.array(v)
            near = sorted((-round(float(v @ np.array(x) / np.linalg.norm(v) / np.linalg.norm(x)), 12), j)
                          for b, (j, x) in enumerate(table) if b != a)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in got) == sorted(want)
