"""Periodic runs against brute force, and the query's columns against plain Python."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from martlight.llm import periodic as P
from martlight.llm.queries import op11_periodic_runs
from tests.llm.common import LONG, SF, WORD, awkward, documents, empty, rows


def plain_runs(w: list) -> list[tuple]:
    """start, length, period of every run, by definition."""
    found: dict[tuple, int] = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= 3 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= max(6, 4 * q)),
                  key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text) -> tuple:
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def search(texts: list[list[str]]) -> list[list[tuple]]:
    runs, _ = P._search([[w.encode() for w in t] for t in texts])
    return [[(r["start"], r["length"], r["period"]) for r in x] for x in runs.to_pylist()]


def test_random_sequences_equal_brute_force():
    rng = random.Random(7)
    for _ in range(500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 150), rng.choice([1, 2, 3, 20])
            w = [str(rng.randrange(k)) for _ in range(n)]
            for _ in range(rng.randint(0, 3)):
                if n > 4:
                    a, p = rng.randrange(n), rng.randint(1, n // 4 + 1)
                    for i in range(a + p, min(n, a + rng.randint(1, n))):
                        w[i] = w[i - p]
            texts.append(w)
        assert search(texts) == [plain_runs(t) for t in texts]


def test_nested_runs_and_runs_side_by_side():
    inner = "a a a a a a b".split()
    text = inner * 5 + ["x"] + "c d".split() * 4 + "d c".split() * 4
    assert search([text]) == [plain_runs(text)]
    assert (0, 35, 7) in search([text])[0] and (0, 6, 1) in search([text])[0]


def test_self_similar_sequences():
    """Fibonacci and Thue-Morse words hold many equal contexts and few runs."""
    a, b = "0", "01"
    while len(b) < 800:
        a, b = b, b + a
    morse = [str(bin(i).count("1") % 2) for i in range(1024)]
    for w in (list(b), morse, list(b) * 4, morse[:64] * 9):
        assert search([w]) == [plain_runs(w)]


def test_synchronising_positions_depend_on_their_context_alone():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 50, 200)
    word = np.concatenate([rng.integers(0, 50, 90), passage, rng.integers(0, 50, 77), passage])
    block, tau = P._mixed(word.astype(np.uint64), np.zeros(1, np.uint64)), 8
    for width in (1, 2, 4):
        block = P._mixed(block[:-width], block[width:])
    at = P.synchronising(block, tau, np.zeros(len(block), bool))
    first, second = ({i - lo for i in at.tolist() if lo <= i <= lo + 200 - 2 * tau} for lo in (90, 367))
    assert first == second and np.diff(sorted(first)).max() <= tau


def test_query_equals_plain_python(spark):
    got = {r[0]: r for r in rows(op11_periodic_runs(spark, SF))}
    assert got == {d: plain_row(d, t) for d, t in documents()}
    assert sum(r[1] > 0 for r in got.values()) > 10


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    docs = awkward(spark, extra)
    found = P.with_runs(docs, P.repeat_tail)
    assert found.columns == [*docs.columns, "runs", "collapsed"]
    assert found.count() == docs.count()
    small = {r[0]: r for r in rows(P.digests(found)) if r[0] in (1, 2, 3, 4, 8, 9, 10, None)}
    assert small == {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in small}


def test_long_text_with_runs(spark):
    text = LONG + " " + "one two three " * 3000 + LONG
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = P.with_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(40_000, 9000, 3)]
    assert row["collapsed"] == f"{LONG} one two three {LONG}"


def test_empty_table_and_replaced_columns(spark):
    assert rows(P.digests(P.with_runs(empty(spark)))) == []
    docs = spark.createDataFrame([(1, "a " * 9, "x")], "doc_id long, text string, RUNS string")
    assert P.with_runs(docs).columns == ["doc_id", "text", "runs", "collapsed"]
