"""Toxicity grammar: transducers, events, fitting, held-out accuracy, awkward rows."""
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martlight.llm import queries, toxicity as tox
from tests.llm.common import awkward, empty, rows

MODEL = tox.Model(stems={"idiot": 4.0, "lowei": 4.0}, bias=-3.0)


def events(text):
    return [e[2] for e in MODEL.events(text)]


def test_composition_equals_running_one_after_another():
    a, b = tox._insult().compose(tox._threat()), tox._marker("Y", "y", 0.3, (tox.OTHER, "I", "T", "Y", "N", "R"), 3)
    both = a.compose(b)
    rng = np.random.default_rng(0)
    for _ in range(200):
        word = rng.choice(list(both.alphabet), size=rng.integers(1, 12)).tolist()
        middle = [o for _, o, _ in a.run(word)]
        assert [o for _, o, _ in both.run(word)] == [o for _, o, _ in b.run(middle)]


@pytest.mark.parametrize("text,want", [
    ("such an idiot", ["I"]), ("you are an idiot", ["Iy"]), ("he is no idiot", ["Iyn"]), ("he is not such an idiot", ["In"]),
    ("she said he is an idiot", ["Iyr"]), ("you. an idiot", ["I"]),
    ("they will hurt you", ["Ty"]), ("it will hurt", ["T"]), ("it must hurt", ["T"]), ("hurt", []),
    ("will he ever come and hurt", []), ("Idiots! LOWEISCHAFT", ["I", "I"]), ("nonidiot", []),
    ("you one two three four idiot", ["I"]), ("", []), ("...", []),
])
def test_events(text, want):
    assert events(text) == want


def test_clauses_not_isolated_words_are_scored():
    plain, targeted, negated = (MODEL.events(t)[0][3] for t in ("the idiot", "you idiot", "no idiot"))
    assert targeted > plain > negated
    spans = MODEL.events("one\nyou idiot, idiot")
    assert [(a, b) for a, b, *_ in spans] == [(8, 13), (15, 20)]


def test_score_is_monotone_and_bounded():
    s = [MODEL.score(t) for t in ("", "fine words", "an idiot", "you idiot. you idiot")]
    assert s[0] == s[1] < s[2] < s[3] <= 1 and s[0] > 0
    assert 0 < MODEL.score("idiot " * 50_000) <= 1


def test_stems_need_more_than_chance_and_generalise():
    words = {f"lowei{x}": (0, 30) for x in "abcdefgh"} | {"lower": (40, 1), "plain": (100, 12), "rare": (0, 2)}
    stems = {}
    for w, (clean, toxic) in words.items():
        for n in range(tox.STEM_MIN, len(w) + 1):
            a, b = stems.get(w[:n], (0, 0))
            stems[w[:n]] = (a + clean, b + toxic)
    assert list(tox.choose_stems(stems, words, 0.1)) == ["lowei"]
    assert tox.choose_stems({}, {}, 0.1) == {}


def test_near_copies_share_a_sketch():
    words = [f"w{i}" for i in range(400)]
    copies = {tox._sketch(words[:i] + ["new"] + words[i + 1:]) for i in range(0, 400, 7)}
    assert len(copies) < 6 and tox._sketch(["one"]) >= 0


def test_held_out_fold(spark):
    got = dict(rows(spark.range(300).select("id", tox.held_out(F.col("id")))))
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op1_toxicity(spark, sf).toPandas()
    docs = duckdb.sql(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall()
    assert sorted(out.doc_id) == sorted(d for d, in docs)
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    part = out[out.held_out & out.doc_id.isin(truth)]
    y = part.doc_id.map(truth).to_numpy()
    assert ((part.score >= 0.7).astype(int) == part.predicted).all()
    hit = (part.predicted == 1).to_numpy()
    assert hit[y == 1].mean() > 0.9 and hit[y == 0].mean() < 0.01


def labels(spark, data):
    return spark.createDataFrame(data, "doc_id long, toxic int")


def test_held_out_labels_change_nothing(spark):
    docs = awkward(spark)
    a = labels(spark, [(1, 0), (2, 1), (6, 0), (9, 1)])
    kept = a.where(~tox.held_out(F.col("doc_id")))
    assert tox.fit(docs, a) == tox.fit(docs, kept)


def test_awkward_rows_and_reject(spark):
    df = awkward(spark).withColumn("predicted", F.lit("old"))
    out = tox.score(df, MODEL).collect()
    assert len(out) == df.count() and all(0 < r["score"] < 1 for r in out)
    assert {r["predicted"] for r in out} == {0}
    same = [r["score"] for r in out if r["doc_id"] in (1, 5)]
    assert len(set(same)) == 1
    kept = tox.reject(df, labels(spark, [(1, None), (None, 1)]))
    assert kept.columns == df.columns and kept.count() == df.count()


def test_empty_tables(spark):
    assert tox.score(empty(spark), MODEL).collect() == []
    assert tox.fit(empty(spark), labels(spark, [])) == tox.Model()
    assert tox.reject(empty(spark), labels(spark, [(1, 1), (2, 0)])).collect() == []


def test_a_long_clause_is_read_from_its_start():
    """A reporting verb thousands of words back marks the event; a clause end between does not."""
    m = tox.Model(stems={"idiot": 2.0})
    filler = "word " * 5000
    assert [e[2] for e in m.events("he said " + filler + "an idiot and " + filler + "idiot")] == ["Ir", "Ir"]
    assert [e[2] for e in m.events("he said. " + filler + "idiot")] == ["I"]
    assert [e[2] for e in m.events(filler + "idiot. she said idiot. idiot")] == ["I", "Iyr", "I"]
