"""Spelling variants against brute force."""
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from martlight.llm import spelling as S
from martlight.llm.queries import op13_spelling_variants
from tests.llm.common import SF, awkward, documents, empty, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs, edit=True) -> dict[str, int]:
    counts: Counter = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{w}".encode())
            if edit and d is not None and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def patterns(w: str) -> set:
    """Two words one edit apart share a pattern: a letter left open, left out or added."""
    return ({(w[:i], w[i + 1:]) for i in range(len(w))} | {(w[:i], w[i:]) for i in range(len(w) + 1)})


def plain_variants(words: dict[str, int]) -> dict[str, tuple]:
    by = defaultdict(set)
    for w in words:
        for p in patterns(w):
            by[p].add(w)
    near = {w: {x for p in patterns(w) for x in by[p] if S.one_edit(w, x)} for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def test_one_edit_is_edit_distance_one():
    rng = random.Random(2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]
    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in "12")
        assert S.one_edit(a, b) == (distance(a, b) == 1)


@pytest.mark.parametrize("node_words", [3, 60, S.NODE_WORDS])
def test_pairs_equal_brute_force(spark, node_words):
    """Also words beyond the longest class, counts beyond the largest, and one vector for many words."""
    rng = random.Random(node_words)
    letters = "abcdnoqÀÿ×"
    words = {}
    while len(words) < 400:
        w = "".join(rng.choice(letters[:rng.choice([1, 2, 4, 10])]) for _ in range(rng.choice([7, 8, 9, 10, 30, 31, 32, 45])))
        words[w] = rng.choice([2, 3, 40])
        for _ in range(3):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words[rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])] = rng.choice([2, 50])
    items = sorted(words.items())
    df = spark.createDataFrame([(w, n, int(k)) for (w, n), k in zip(items, S.vectors([w for w, _ in items]))],
                               "word string, n long, key long")
    got = Counter((min(r["a"], r["b"]), max(r["a"], r["b"])) for r in S.near_pairs(df, node_words).collect())
    by = defaultdict(set)
    for w in words:
        for p in patterns(w):
            by[p].add(w)
    want = {(a, b) for group in by.values() for a in group for b in group if a < b and S.one_edit(a, b)}
    assert set(got) == want and set(got.values()) == {1}


def test_query_equals_brute_force(spark):
    words = plain_words(documents())
    got = rows(op13_spelling_variants(spark, SF).select("word", "form", "root", "n", "n_near", "form_n"))
    assert sorted(got) == sorted(plain_variants(words).values())
    assert sum(r[1] is not None for r in got) > 5


def test_roots_follow_forms_to_the_last(spark):
    chain = [f"w{i:02}" for i in range(20)]
    forms = [(a, b) for a, b in zip(chain, chain[1:])] + [(f"x{i}", "w05") for i in range(50)]
    got = dict(rows(S.roots(spark.createDataFrame(forms, "word string, form string"))))
    assert got == {w: "w19" for w, _ in forms}


def test_forms_of_a_frequent_word(spark):
    docs = [(None, "Believe " * 1000 + "beleve " * 30 + "belive " * 30 + "beleave " * 3 + "believe Éclairs éclairs " * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: r for r in rows(S.variants(df).select("word", "form", "root", "n", "n_near", "form_n"))}
    assert got == {w: r for w, r in plain_variants(plain_words(docs)).items()}
    assert "Éclairs" in got and "éclairs" in got


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    docs = awkward(spark, extra)
    want = plain_variants(plain_words([(r["doc_id"], r["text"]) for r in docs.collect()]))
    got = rows(S.variants(docs, S.drop_letter).select("word", "form", "root", "n", "n_near", "form_n"))
    assert sorted(got) == sorted(want.values())


def test_empty_table(spark):
    assert rows(S.variants(empty(spark))) == []
