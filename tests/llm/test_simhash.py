"""SimHash fingerprints, links and components against brute force."""
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from martlight.llm import queries, simhash
from martlight.llm.components import components
from tests.llm.common import SF, WORD, awkward, documents, empty, rows


def plain_fingerprint(text, k=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs):
    """pairs: (doc_id, fp) -> {fp: smallest doc_id reachable}."""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parent[find(b)] = find(a)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {f: least.get(find(f)) for f in fps}


def check(df, docs):
    fps = [(d, plain_fingerprint(t)) for d, t in docs]
    want = plain_components(fps)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(rows(df), key=key) == sorted(((d, f"{f:016x}", want[f]) for d, f in fps), key=key)


def test_query_equals_brute_force(spark):
    check(queries.op9_simhash(spark, SF), documents())


def test_awkward_rows(spark):
    df = awkward(spark)
    check(simhash.near_duplicates(df), [(r["doc_id"], r["text"]) for r in df.collect()])
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 6, 8, 9, 10] and ids.count(None) == 1


def test_empty_table(spark):
    assert rows(simhash.near_duplicates(empty(spark))) == []
    assert rows(simhash.deduplicate(empty(spark))) == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\né ", max_size=40))
def test_fingerprint_equals_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_cluster(seed, n, spread):
    """Fingerprints around a few centres, many within the distance."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randrange(spread)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("block", [8, 64, 2048])
def test_links_lose_no_component_in_dense_groups(spark, block):
    fps = near_cluster(block, 300, 7) + [0, 1, (1 << 64) - 1]
    fps = sorted(set(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.links(df, block=block)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    want = plain_components(list(enumerate(fps)))
    groups = {}
    for f, s in zip(fps, signed):
        groups.setdefault(want[f], set()).add(found.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    for r in links.collect():                     # spanning links stay inside a component
        u, v = r["u"] % 2**64, r["v"] % 2**64
        assert want[u] == want[v]


def test_forest_finds_every_distance_up_to_four():
    rng = random.Random(3)
    for bits in range(0, 7):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), bits):
            b ^= 1 << i
        found = False
        width, offset = simhash._layout(5)
        for i in range(5):
            if (a >> offset[i] ^ b >> offset[i]) & ((1 << width[i]) - 1) == 0:
                child, _ = simhash.forest(np.zeros(2, np.int64), np.full(2, i), np.full(2, 2),
                                          np.array([a, b], dtype=np.uint64))
                found |= len(child) == 1
        assert found == (bits <= 4), bits


def test_tau_must_leave_an_equal_segment(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), tau=5)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-6, 30), st.integers(-6, 30)), max_size=40))
def test_components_equal_union_find(spark, pairs):
    links = spark.createDataFrame([*pairs, (None, 3)], "u long, v long")
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {r["node"]: r["root"] for r in components(links).collect()} == {x: find(x) for x in parent}


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub, "u long, v long")).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 201 + 300


def test_linked_rows_without_ids_leave_one(spark):
    """Two texts a bit apart under null ids are one group, as they are under ids."""
    base = [f"w{i}" for i in range(400)]
    near = [*base[:-1], "other"]
    texts = [" ".join(base), " ".join(near), " ".join(base)]
    a, b = (simhash.fingerprint(t) for t in texts[:2])
    assert 0 < (a ^ b).bit_count() <= 4
    for ids in ((1, 2, 3), (None, None, None), (None, 2, None)):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        assert simhash.deduplicate(df).count() == 1
