"""Mixture-controlled packing: pieces against whole-text tokenization, window shares, the round-robin."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from martlight.llm import mixture as M
from martlight.llm.queries import op12_mixture_packing, tokenizer_path
from tests.llm.common import SF, awkward, empty

PATH = tokenizer_path("word_bpe_49k.json")


def ids_of(rows) -> list[tuple]:
    """doc_id, source, ids of every row."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    return [(r["doc_id"], r["source"], np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4"))
            for r in rows]


def check(pieces, ids, capacity=4096) -> dict:
    """Every id in exactly one piece, sequences gapless and without padding; their tokens by source."""
    want, got = Counter(), Counter()
    parts = defaultdict(list)
    for doc, source, x in ids:
        want[doc, source, len(x)] += 1
    for p in pieces:
        parts[p["doc_id"], p["source"], p["doc_tokens"]].append((p["start"], p["length"], p["ids_crc32"]))
    by_key = defaultdict(list)
    for doc, source, x in ids:
        by_key[doc, source, len(x)].append(x)
    for key, found in parts.items():
        cover = Counter()
        for s, n, crc in found:
            assert any(zlib.crc32(x[s:s + n].tobytes()) == crc for x in by_key[key])
            cover.update(range(s, s + n))
        assert cover == Counter({i: want[key] for i in range(key[2])})
        got[key] = want[key]
    assert got == want
    windows, held = defaultdict(list), defaultdict(Counter)
    for p in pieces:
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        held[p["sequence_id"]][p["source"]] += p["length"]
    for spans in windows.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == capacity or at < capacity and at & (at - 1) == 0
    return held


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, ids_of(docs.collect())


def test_query_packs_every_id_and_mixes_every_window(spark, small):
    _, ids = small
    out = op12_mixture_packing(spark, SF)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    held = check(out.collect(), ids)
    total = sum(len(x) for _, _, x in ids)
    share = Counter()
    for _, s, x in ids:
        share[s] += len(x)
    full = [c for c in held.values() if sum(c.values()) == 4096]
    assert len(full) == total // 4096 and len(held) - len(full) <= 12
    for c in full:
        assert max(abs(c[s] - 4096 * share[s] / total) for s in share) <= 2 * M.CHUNK


def test_deficits_are_carried_over_windows_and_segments(spark, small):
    """Over any first windows, every source is within two chunks of its share."""
    docs, ids = small
    held = check(M.pack(docs, PATH, 2, capacity=512, segment=20_000).collect(), ids, 512)
    total = sum(len(x) for _, _, x in ids)
    share = Counter()
    for _, s, x in ids:
        share[s] += len(x)
    sent, at = Counter(), 0
    for w in sorted(held):
        sent.update(held[w])
        at += sum(held[w].values())
        assert max(abs(sent[s] - at * share[s] / total) for s in share) <= 2 * M.CHUNK


def test_given_targets_hold_until_a_source_runs_out(spark, small):
    docs, ids = small
    names = sorted({s for _, s, _ in ids})
    weights = {s: 1.0 + i % 3 for i, s in enumerate(names)}
    held = check(M.pack(docs, PATH, 2, targets=weights, segment=30_000).collect(), ids)
    total = Counter()
    for _, s, x in ids:
        total[s] += len(x)
    all_weights = sum(weights.values())
    until = min(total[s] / weights[s] for s in names) * all_weights // 4096      # windows all sources last
    assert until >= 1
    for w in range(int(until)):
        assert max(abs(held[w][s] - 4096 * weights[s] / all_weights) for s in names) <= 2 * M.CHUNK
    with pytest.raises(ValueError):
        M.pack(docs, PATH, 2, targets={names[0]: 1.0})


def test_order_is_deficit_round_robin():
    """Against a plain simulation with counters."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        weight = rng.integers(1, 2000, 6).astype(float)
        begun = float(rng.uniform(0, 3))
        queues, source, end = [], [], []
        for s in range(6):
            sent = int(begun * weight[s]) - int(rng.integers(0, 200))
            chunks = []
            for n in rng.integers(1, 257, rng.integers(1, 12)).tolist():
                sent += n
                chunks.append((n, sent))
            queues.append(chunks)
            source += [s] * len(chunks)
            end += [e for _, e in chunks]
        got = M._order(np.array(source), weight[source], np.array(end), begun)
        quantum = M.ROUND * weight / weight.sum()
        deficit = [begun * weight[s] - (queues[s][0][1] - queues[s][0][0]) for s in range(6)]
        want, at = [], [0] * 6
        while any(at[s] < len(queues[s]) for s in range(6)):
            for s in range(6):
                while at[s] < len(queues[s]) and queues[s][at[s]][0] <= deficit[s] + 1e-9:
                    deficit[s] -= queues[s][at[s]][0]
                    want.append((s, queues[s][at[s]][1]))
                    at[s] += 1
            deficit = [d + q for d, q in zip(deficit, quantum)]
        assert [(source[i], end[i]) for i in got.tolist()] == want


def test_many_tiny_sources_are_spread(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'some words of a text' as text", "concat('s', id) as source")
    out = M.pack(docs, PATH, 2, capacity=1024, segment=1500).collect()
    check(out, ids_of(docs.collect()), 1024)


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    docs = awkward(spark, extra)
    check(M.pack(docs, PATH, 2, segment=10_000).collect(), ids_of(docs.collect()))


def test_empty_table(spark):
    assert M.pack(empty(spark), PATH, 2).collect() == []


def test_rest_is_cut_into_powers_of_two():
    assert M.windows(4096 * 3 + 2048 + 5, 4096) == [12288, 14336, 14340]
    assert M.windows(8192, 4096) == []
