"""Content-defined chunking: cuts, shifts, spans, awkward rows, planted passages."""
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martlight.llm import cdc, queries
from tests.llm.common import SF, awkward, documents, empty


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_rolling_hash_is_the_sum_over_the_window():
    data = np.frombuffer(words(random.Random(1), 30).encode(), np.uint8)
    h = cdc.rolling(data)
    for i in (0, 1, 5, 15, 16, 40, len(data) - 1):
        want = sum(int(cdc.GEAR[data[i - j]]) << 2 * j for j in range(min(cdc.WINDOW, i + 1))) % 2**32
        assert h[i] == want


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=2000))
def test_chunks_cover_the_text_within_bounds(data):
    ends = cdc.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert (ends[-1] if ends else 0) == len(data)
    assert all(0 < s <= cdc.MAX_CHUNK for s in sizes) and all(s >= cdc.MIN_CHUNK for s in sizes[:-1])


def test_chunks_resist_insertions():
    rng = random.Random(2)
    a = words(rng, 600).encode()
    b = a[:700] + b"inserted text " + a[700:]
    cut = lambda x: {x[i:j] for i, j in zip([0, *cdc.chunk_ends(x)], cdc.chunk_ends(x))}
    assert len(cut(a) & cut(b)) > 0.9 * len(cut(a))


def test_monotonous_text_is_cut_at_one_phase():
    a = cdc.chunk_ends(b"La " * 400)
    b = cdc.chunk_ends(b"intro " + b"La " * 400)
    assert len(set(np.diff(a)[1:-1])) == 1 and set(np.diff(b)[2:-1]) == set(np.diff(a)[1:-1])


def planted(spark):
    rng = random.Random(3)
    passage = words(rng, 80)
    short = words(rng, 9)
    docs = {1: f"{words(rng, 120)} {passage} {words(rng, 40)}",
            2: f"{words(rng, 33)} {passage} {words(rng, 77)}",
            3: passage, 4: f"{words(rng, 200)}\n{short}", 5: f"{short}\n{words(rng, 150)}",
            6: f"{words(rng, 5)} {passage} {words(rng, 7)} {passage}"}
    return passage, docs, spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")


def test_planted_passages_stay_once(spark):
    passage, docs, df = planted(spark)
    got = {r["doc_id"]: r for r in cdc.without_repeats(df).collect()}
    assert got[1]["text"] == docs[1] and got[4]["text"] == docs[4] and got[5]["text"] == docs[5]
    inner = set(passage.split())
    for d in (2, 3, 6):
        assert len(inner & set(got[d]["text"].split())) < 0.35 * len(inner)
        text, kept, last = docs[d], [], 0
        for s in got[d]["removed"]:               # the spans give the cut
            kept.append(text[last:s["start"]])
            assert len(text[s["start"]:s["end"]].split()) >= cdc.MIN_WORDS
            last = s["end"]
        assert "".join(kept) + text[last:] == got[d]["text"]
        assert got[d]["n_removed"] == len(docs[d]) - len(got[d]["text"])
    own = set(docs[2].split()) - inner
    assert own <= set(got[2]["text"].split())


def test_deduplicate_counts_and_drops(spark):
    from pyspark.sql import functions as F
    _, docs, df = planted(spark)
    again = df.where("doc_id = 4").withColumn("doc_id", F.lit(9).cast("long"))
    df = df.union(again).withColumn("n_chars", F.length("text")).withColumn("source", F.lit("s"))
    out = {r["doc_id"]: r for r in cdc.deduplicate(df).collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    assert 9 not in out or len(out[9]["text"]) < 0.3 * len(docs[4])
    assert cdc.deduplicate(df).columns == df.columns


def test_query_catches_repeated_passages(spark):
    got = {r["doc_id"]: r for r in queries.op8_substring_dedup(spark, SF).collect()}
    first, hit, total = {}, 0, 0
    for d, text in documents():
        w = (text or "").split()
        marked = set()
        for i in range(len(w) - 50):
            if first.setdefault(tuple(w[i:i + 51]), d) != d:
                marked.update(range(i, i + 51))
        total += len(marked)
        if marked:
            hit += min(len(marked), len(w) - len(got[d]["text"].split()))
    assert total and hit > 0.85 * total


def test_awkward_rows(spark):
    df = awkward(spark)
    out = cdc.without_repeats(df)
    got = out.collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["text"] is None and by[3][0]["text"] == "" and by[4][0]["text"] == " \t\n "
    assert by[6][0]["n_removed"] == 0 and by[7][0]["n_removed"] > 0.9 * len(by[6][0]["text"])
    assert [r["text"] for r in by[5]] == [by[5][0]["text"]] * 2
    assert cdc.deduplicate(df).columns == df.columns


def test_empty_table(spark):
    assert cdc.without_repeats(empty(spark)).collect() == []


def test_rows_without_id_or_with_one_id_are_cut_each_by_itself(spark):
    rng = random.Random(5)
    a, b, c, d = (words(rng, 120) for _ in range(4))
    data = [(1, a), (None, a), (None, b), (None, c), (None, c), (7, d), (7, words(rng, 60) + " " + a)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    texts = sorted(r["text"] for r in cdc.without_repeats(df).where("doc_id is null").collect())
    assert b in texts and texts.count(c) == 1            # clean rows stay, copies among null ids go
    assert sum(len(t) > 0.5 * len(a) for t in texts) == 2
    seven = [r["text"] for r in cdc.without_repeats(df).where("doc_id = 7").collect()]
    assert d in seven and any(data[6][1][:300] in t and len(t) < 0.6 * len(data[6][1]) for t in seven)
    kept = [r["text"] for r in cdc.deduplicate(df).where("doc_id is null").collect()]
    assert b in kept and c in kept


def test_largest_and_smallest_ids_keep_their_order(spark):
    text = words(random.Random(6), 150)
    ids = [2**63 - 1, None, -2**63, -5]
    df = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    assert [r["doc_id"] for r in cdc.without_repeats(df).collect() if not r["n_removed"]] == [-2**63]
    df = df.where("doc_id is null or doc_id > 0")
    assert [r["doc_id"] for r in cdc.without_repeats(df).collect() if not r["n_removed"]] == [2**63 - 1]


def unheld(df, out, n=cdc.MIN_WORDS):
    """Windows of ``n`` words inside one cut that no earlier row holds (ids are unique)."""
    texts, first, lost = {r["doc_id"]: r["text"] for r in df.collect()}, {}, 0
    removed = {r["doc_id"]: r["removed"] for r in out.collect()}
    for d in sorted(texts):
        for s in removed[d]:
            w = texts[d][s["start"]:s["end"]].split()
            lost += sum(first.get(tuple(w[i:i + n]), d) == d for i in range(len(w) - n + 1))
        w = texts[d].split()
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i:i + n]), d)
    return lost


def test_passages_joined_from_different_rows_stay(spark):
    rng = random.Random(8)
    data, parts = [], []
    for i in range(14):                                  # whole chunks of 12 words or less from each
        raw = words(rng, 80).encode()
        data.append((i, raw.decode()))
        ends = cdc.chunk_ends(raw)
        to = max(e for e in ends if len(raw[ends[1]:e].split()) <= 12)
        parts.append(raw[ends[1]:to].decode())
    data.append((100, "".join(parts)))                   # no 20 words of it stand elsewhere
    assert len("".join(parts).split()) >= 2 * cdc.MIN_WORDS
    long = [words(rng, 60), words(rng, 60)]
    data += [(101, f"{words(rng, 9)} {long[0]} {words(rng, 9)}"), (102, f"{words(rng, 9)} {long[1]} {words(rng, 9)}"),
             (103, " ".join(long)), (104, " ".join(long))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = cdc.without_repeats(df)
    got = {r["doc_id"]: r for r in out.collect()}
    texts = dict(data)
    assert got[100]["text"] == texts[100]
    assert unheld(df, out) == 0
    assert got[103]["n_removed"] > 0.6 * len(texts[103]) and got[104]["n_removed"] > 0.9 * len(texts[104])


def test_groups_do_not_depend_on_what_stands_before():
    rng = random.Random(9)
    a = words(rng, 400).encode()
    x, y = cdc.groups(a, 20), cdc.groups(words(rng, 70).encode() + b" " + a, 20)
    assert len(set(x[0].tolist())) == len(x[0]) and len(set(x[0].tolist()) & set(y[0].tolist())) >= len(x[0]) - 4
    assert all(len(a[i:i + n].split()) >= 20 for i, n in zip(x[1].tolist(), x[2].tolist()))


def test_every_cut_of_the_query_stands_in_an_earlier_document(spark):
    df = spark.createDataFrame([(d, t or "") for d, t in documents()], "doc_id long, text string")
    out = queries.op8_substring_dedup(spark, SF)
    assert out.where("n_removed > 0").count() and unheld(df, out) == 0
