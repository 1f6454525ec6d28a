"""Packing: pieces, the genetic operators, valid sequences, few of them, awkward rows."""
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlight.llm import packing as pk, queries
from tests.llm.common import SF, awkward, documents, empty

SIZES = st.lists(st.integers(1, 100), min_size=1, max_size=60)


def valid(bins, length, capacity=100):
    flat = sorted(x for b in bins for x in b)
    return flat == list(range(len(length))) and all(0 < sum(length[x] for x in b) <= capacity for b in bins)


@settings(max_examples=80, deadline=None)
@given(SIZES, st.integers(0, 99))
def test_operators_keep_a_valid_packing(length, seed):
    rng = np.random.default_rng(seed)
    a = pk.best_fit(range(len(length)), length, [], 100)
    b = pk.best_fit(sorted(range(len(length)), key=lambda x: -length[x]), length, [], 100)
    before = [list(x) for x in a], [list(x) for x in b]
    child, mutant = pk.crossover(a, b, length, 100, rng), pk.mutate(b, length, 100, rng)
    assert all(valid(x, length) for x in (a, b, child, mutant))
    assert (a, b) == before                                   # parents are not changed
    best = pk.evolve(length, 100, seed)
    assert valid(best, length) and pk.lower_bound(np.array(length), 100) <= len(best) <= len(b)


def test_best_fit_takes_the_fullest_bin_that_fits():
    assert pk.best_fit([0, 1, 2, 3], [60, 70, 25, 40], [], 100) == [[0, 3], [1, 2]]


def test_lower_bound_counts_big_pieces():
    assert pk.lower_bound(np.array([51] * 10), 100) == 10
    assert pk.lower_bound(np.array([50] * 10), 100) == 5
    assert pk.lower_bound(np.array([60, 60, 45, 45]), 100) == 3


def test_evolution_beats_its_first_chromosome():
    # triplets that fill bins exactly: best-fit decreasing misses some
    rng = np.random.default_rng(4)
    length = []
    for _ in range(40):
        a = int(rng.integers(26, 48))
        b = int(rng.integers(26, 100 - a - 25))
        length += [a, b, 100 - a - b]
    first = pk.best_fit(np.argsort(-np.array(length)).tolist(), length, [], 100)
    best = pk.evolve(length, 100, 1, generations=400, population=8)
    assert valid(best, length) and len(best) <= len(first)
    assert len(pk.evolve(length, 100, 2, elite=[best])) <= len(best)


def expected_pieces(docs, capacity=1024):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = []
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at, i = 0, 0
        while at < len(ids):
            z = len(ids) if len(ids) <= capacity else at + ((len(ids) % capacity or capacity) if i == 0 else capacity)
            out.append((d, i, at, z - at, zlib.crc32(np.array(ids[at:z], "<u4").tobytes())))
            at, i = z, i + 1
    return out


def check(out, docs, capacity=1024):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])          # noqa: E731
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(got, key=key) == sorted(expected_pieces(docs, capacity), key=key)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), pk.lower_bound(np.array([r["length"] for r in out]), capacity) if out else 0


def test_query_is_valid_and_near_the_bound(spark):
    n, least = check(queries.op6_packing(spark, SF).collect(), documents())
    assert n <= least * 1.02 + 1


def test_several_blocks_islands_and_leftovers(spark, monkeypatch):
    monkeypatch.setattr(pk, "BLOCK", 30)
    docs = [(i, "word " * (7 * i % 90)) for i in range(260)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    n, least = check(pk.pack(df, P.path("byte_bpe_50k.json"), 2, capacity=64).collect(), docs, 64)
    assert n <= least * 1.05 + 2


def test_awkward_rows(spark):
    df = awkward(spark)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    check(pk.pack(df, P.path("byte_bpe_50k.json"), 2).collect(), docs)


def test_empty_table(spark):
    assert pk.pack(empty(spark), P.path("byte_bpe_50k.json"), 2).collect() == []
