"""Merkle fingerprints and neighbours against a plain Python tree."""
import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlight.llm import merkle, queries
from tests.llm.common import SF, awkward, documents, empty, rows


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_fingerprint(text):
    def leaves(p):
        return [sha(p[i:i + merkle.PIECE]) for i in range(0, len(p), merkle.PIECE)] or [sha("")]

    tree = [[leaves(p) for p in s.split("\n")] for s in re.split("\n\n+", text)]
    sections = "".join(sha("".join(sha("".join(p)) for p in s)) for s in tree)
    root = sha(sections + "/" + sha(re.sub("[^\n]+", ".", text)))[:32]
    return root + ":" + ";".join(",".join("".join(d[:6] for d in p) for p in s) for s in tree)


def plain_likeness(a, b):
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    x, y = ({p[i:i + 6] for p in re.split("[,;]", f.split(":")[1]) for i in range(0, len(p), 6)} for f in (a, b))
    return min(0.999, len(x & y) / max(len(x), len(y), 1))


def expected(docs):
    """docs: (doc_id, text), in the order of the walk."""
    out = []
    for i, (d, t) in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)][1]
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        f, g, h = plain_fingerprint(t), plain_fingerprint(e), plain_fingerprint(nxt)
        out.append((d, len(t), sha(e), f, g, plain_likeness(f, g), plain_likeness(f, h)))
    return out


def test_query_equals_brute_force(spark, monkeypatch):
    docs = sorted(((d, t or "") for d, t in documents()), reverse=True)
    assert sorted(rows(queries.op4_merkle(spark, SF))) == sorted(expected(docs))
    monkeypatch.setattr(merkle, "PER_RANGE", 13)         # many ranges
    assert sorted(rows(queries.op4_merkle(spark, SF))) == sorted(expected(docs))


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PER_RANGE", 3)
    df = awkward(spark)
    got = merkle.compare(df).collect()
    docs = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    named = sorted(((d, t) for d, t in docs if d is not None), key=lambda r: (r[0], r[1].encode()), reverse=True)
    docs = named + [(d, t) for d, t in docs if d is None]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])      # noqa: E731
    assert sorted(map(tuple, got), key=key) == sorted(expected(docs), key=key)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (1, 5)}
    assert len(same) == 1 and got[0]["near_edited"] <= 1


def test_many_null_ids_and_one_row(spark):
    df = spark.createDataFrame([(None, f"text {i} " * 9) for i in range(20)], "doc_id long, text string")
    out = merkle.compare(df).collect()
    assert len(out) == 20
    one = merkle.compare(df.limit(1)).first()
    assert one["near_next"] == 1.0


def test_empty_table(spark):
    assert rows(merkle.compare(empty(spark))) == []


def test_layout_counts_and_edits_are_located(spark):
    a = "one line\nsecond line\n\nsection two\n\nthird section of this text"
    b = a.replace("second", "sekond")
    df = spark.createDataFrame([(a, b, a + "\n", a.replace("\n\n", "\n\n\n", 1))], "a string, b string, c string, d string")
    r = df.select(*[merkle.fingerprint(F.col(c)).alias(c) for c in "abcd"]).withColumn(
        "at", merkle.changed_pieces(F.col("a"), F.col("b"))).first()
    assert len({r[c][:32] for c in "abcd"}) == 4
    assert [tuple(x) for x in r["at"]] == [(0, 1)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab\n é😀", max_size=120), min_size=1, max_size=12))
def test_fingerprint_on_random_texts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(merkle.fingerprint(F.col("text"))).collect()] == list(map(plain_fingerprint, texts))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab\n\r\x85\u2028\u2029 é", max_size=120), min_size=1, max_size=12))
def test_fingerprint_on_texts_with_other_line_ends(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(merkle.fingerprint(F.col("text"))).collect()] == list(map(plain_fingerprint, texts))


def test_texts_that_differ_in_line_ends_have_different_roots(spark):
    texts = ["ab", "a\rb", "a\r\rb", "ab\r", "a\x85b", "a\u2028b", "a\u2029b", "a\nb", "a\r\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    roots = [r[0] for r in df.select(merkle.root(merkle.fingerprint(F.col("text")))).collect()]
    assert len(set(roots)) == len(texts)
