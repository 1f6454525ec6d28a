"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause.  Words become symbols (insult, modal, harm
verb, target, negation, reporting verb, other) and five transducers are composed
into one machine over them:

* insult   passes insult words on (the lexicon gives each its weight);
* threat   turns a modal followed closely by a harm verb into a threat;
* target   marks insults and threats that follow closely on a target;
* negation marks those that follow closely on a negation;
* report   marks those after a reporting verb in the same clause.

Only clauses that hold an insult or a threat are run, and what is scored is the
marked event, not the word: its weight is the word's plus the weights of the arcs
taken.  The score is a logistic function of the summed weights, fitted to labels, as
is the insult lexicon: word stems that stand almost only in toxic
documents.  Sketches of documents, not documents, are counted, so a stem repeated
by near copies of one text is no evidence.

The fit reads at most ``max_train_docs`` labelled rows on average (a hash
sample of documented size); scoring reads every row and whole texts.  A null or
empty text has no event and gets the score of the bias alone.  Repeated rows are
scored alike.  Labels that are null are ignored; a document labelled twice counts
as toxic if any row says so.  With no toxic or no clean label the grammar's own
weights and an empty lexicon are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lean, numbered, pick, renamed, require_columns, text_or_empty, written

# --- the grammar ----------------------------------------------------------------

OTHER, INSULT, MODAL, HARM, TARGET, NEGATION, REPORT = "o", "I", "M", "H", "Y", "N", "R"

# Function words of the grammar, in English, German, French and Spanish.
CLASS_WORDS = {
    MODAL: "will shall gonna going must werde wird wirst werden vais va allons voy vamos",
    HARM: "kill hurt shoot stab beat burn destroy töten schlagen verbrennen tuer frapper "
          "brûler matar golpear quemar",
    TARGET: "you your he she they them him her these those du dich dir ihr sie er euch tu "
            "te toi vous ils elles tú ti usted ustedes ellos ellas",
    NEGATION: "not no never nobody nor nicht kein keine nie pas jamais aucun nunca ni",
    REPORT: "said says wrote writes called calls told claimed quoted sagte schrieb nannte "
            "dit écrit appelé dijo escribió llamó",
}

# Prior weight of each event: the arc weights of the transducers add up.
ARC_WEIGHT = {"target": 0.3, "negation": -0.5, "report": -0.4}
THREAT_WEIGHT = 3.0
NEAR = 3                      # words between a marker and the event it marks


@dataclass
class Transducer:
    """Deterministic, total over its alphabet: (state, symbol) -> (state, output, weight)."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    alphabet: tuple[str, ...]

    def compose(self, other: "Transducer") -> "Transducer":
        """The machine that feeds this one's outputs to ``other``; weights add."""
        ids = {(0, 0): 0}
        todo = [(0, 0)]
        arcs: dict[tuple[int, str], tuple[int, str, float]] = {}
        while todo:
            pair = todo.pop()
            for sym in self.alphabet:
                a, mid, w = self.arcs[pair[0], sym]
                b, out, v = other.arcs[pair[1], mid]
                if (a, b) not in ids:
                    ids[a, b] = len(ids)
                    todo.append((a, b))
                arcs[ids[pair], sym] = (ids[a, b], out, w + v)
        return Transducer(arcs, self.alphabet)

    def run(self, symbols) -> Iterator[tuple[int, str, float]]:
        """(position, output, weight) of every symbol."""
        state = 0
        for i, sym in enumerate(symbols):
            state, out, w = self.arcs[state, sym]
            yield i, out, w


_BASE = (OTHER, INSULT, MODAL, HARM, TARGET, NEGATION, REPORT)
_EVENTS = ("I", "T", "Iy", "Ty", "In", "Tn", "Iyn", "Tyn", "Ir", "Tr", "Iyr", "Tyr", "Inr", "Tnr",
           "Iynr", "Tynr")


def _insult() -> Transducer:
    return Transducer({(0, s): (0, s, 0.0) for s in _BASE}, _BASE)


def _threat() -> Transducer:
    """State k > 0: a modal stands k-1 words back at most NEAR."""
    arcs = {}
    for k in range(NEAR + 1):
        for s in _BASE:
            later = 0 if k == 0 or k == NEAR else k + 1
            if s == MODAL:
                arcs[k, s] = (1, OTHER, 0.0)
            elif s == HARM:
                arcs[k, s] = (0, "T", THREAT_WEIGHT) if k else (0, OTHER, 0.0)
            else:
                arcs[k, s] = (later, s, 0.0)
    return Transducer(arcs, _BASE)


def _marker(symbol: str, mark: str, weight: float, alphabet, within: int | None) -> Transducer:
    """Append ``mark`` to events after ``symbol``: at most ``within`` words later,
    or anywhere later in the clause."""
    arcs = {}
    last = 1 if within is None else within
    for k in range(last + 1):
        for s in alphabet:
            later = k if within is None or k == 0 else (k + 1) % (last + 1)
            if s == symbol:
                arcs[k, s] = (1, OTHER, 0.0)
            elif s in _EVENTS:
                arcs[k, s] = (later, s + mark, weight) if k else (later, s, 0.0)
            else:
                arcs[k, s] = (later, s, 0.0)
    return Transducer(arcs, alphabet)


def grammar() -> Transducer:
    """insult o threat o target o negation o report."""
    plain = (OTHER, "I", "T", TARGET, NEGATION, REPORT)
    marked = (*plain, "Iy", "Ty")
    negated = (*marked, "In", "Tn", "Iyn", "Tyn")
    return (_insult().compose(_threat())
            .compose(_marker(TARGET, "y", ARC_WEIGHT["target"], plain, NEAR))
            .compose(_marker(NEGATION, "n", ARC_WEIGHT["negation"], marked, NEAR))
            .compose(_marker(REPORT, "r", ARC_WEIGHT["report"], negated, None)))


# --- the model ------------------------------------------------------------------

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n|]")


@dataclass
class Model:
    """Insult stems with weights, and how a text's summed weight becomes a score."""

    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    scale: float = 1.0
    words: dict[str, str] = field(default_factory=lambda: {
        w: s for s, ws in CLASS_WORDS.items() for w in ws.split()})

    def __post_init__(self):
        self._ready = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def _machine(self):
        if self._ready is None:
            import ahocorasick
            finder = ahocorasick.Automaton()
            for s in self.stems:
                finder.add_word(s, len(s))
            for w in CLASS_WORDS[HARM].split():
                finder.add_word(w, len(w))
            finder.make_automaton()
            self._ready = (finder, grammar().arcs, sorted({len(s) for s in self.stems}))
        return self._ready

    def stem_weight(self, word: str, lengths) -> float:
        """Weight of the longest stem the word starts with (0: none)."""
        best = 0.0
        for n in lengths:
            if n > len(word):
                break
            best = self.stems.get(word[:n], best)
        return best

    def events(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, event, weight) of every event, clause by clause."""
        finder, arcs, lengths = self._machine()
        text = text.lower()
        found: list[tuple[int, int, str, float]] = []
        upto, lo, seen = -1, 0, 0
        for end, n in finder.iter(text):
            at = end - n + 1
            if at < upto or (at and text[at - 1].isalpha()):
                continue
            # the clause begins behind the last end before it: every stretch is looked at once
            lo, seen = max(lo, upto), max(seen, upto, 0)
            for m in _CLAUSE_END.finditer(text, seen, at):
                lo = m.end()
            seen = at
            stop = _CLAUSE_END.search(text, at)
            upto = stop.start() if stop else len(text)
            state = 0
            for m in _WORD.finditer(text, lo, upto):
                w = m.group()
                weight = self.stem_weight(w, lengths)
                sym = INSULT if weight else self.words.get(w, OTHER)
                state, out, extra = arcs[state, sym]
                if out[0] in "IT":
                    found.append((m.start(), m.end(), out, max(0.1, weight + extra)))
        return found

    def weigh(self, text: str) -> float:
        """The summed weight of the text's events."""
        return sum(w for _, _, _, w in self.events(text))

    def score(self, text: str) -> float:
        z = self.bias + self.scale * self.weigh(text)
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


# --- fitting --------------------------------------------------------------------

MAX_TRAIN_DOCS = 20_000       # labelled rows read by the fit, on average
STEM_MIN, STEM_MAX = 3, 10    # letters of a stem


def held_out(doc_id) -> F.Column:
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label per word start, summed within the task."""
    counts: Counter = Counter()
    for b in batches:
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            starts = {w[:n] for w in set(_WORD.findall(text.lower()))
                      for n in range(STEM_MIN, min(len(w), STEM_MAX) + 1)}
            counts.update((s, toxic) for s in starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
         pa.array(list(counts.values()), pa.int64())], ["stem", "toxic", "n"])


def _sketch(words: list[str]) -> int:
    """The least hash of two neighbouring words: near copies of a text share it."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    pairs = zip(words, words[1:]) if len(words) > 1 else [(w, "") for w in words]
    return min(digest(f"{a} {b}") for a, b in pairs) >> 1


def _evidence(shared):
    """(item, toxic, sketch) of every text for its candidate stems, and, marked by a
    leading ``=``, for the words that start with one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems = shared.value
        for b in batches:
            found = []
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                words = _WORD.findall(text.lower())
                items = set()
                for w in set(words):
                    starts = {w[:n] for n in range(STEM_MIN, min(len(w), STEM_MAX) + 1)} & stems
                    if starts:
                        items |= starts | {"=" + w}
                if items:
                    sketch = _sketch(words)
                    found += [(i, toxic, sketch) for i in items]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int32(), pa.int64()))],
                    ["item", "toxic", "sketch"])
    return run


def choose_stems(stems: dict[str, tuple[int, int]], words: dict[str, tuple[int, int]],
                 prior: float) -> dict[str, float]:
    """Lexicon from (clean, toxic) numbers of sketches by stem and by word.

    Stems are taken by their log-likelihood ratio against the prior share, largest first,
    while it exceeds what chance gives over all stems tried; of nested stems only one is
    taken.  A stem is lengthened to what its words have in common; its weight is its log
    odds, so a stem that clean texts hold now and then needs company."""
    def ratio(clean: int, toxic: int) -> float:
        p = toxic / (clean + toxic)
        if p < 0.5 or toxic < 4:
            return 0.0
        return toxic * math.log(p / prior) + (clean * math.log((1 - p) / (1 - prior)) if clean else 0.0)

    ranked = sorted(((ratio(*n), s) for s, n in stems.items()), key=lambda r: (-r[0], len(r[1]), r[1]))
    least = math.log(max(1, len(stems)) / 0.01)
    out: dict[str, float] = {}
    taken: set[str] = set()             # chosen stems and their starts
    for score, s in ranked:
        if score < least:
            break
        if s in taken or any(s[:n] in out for n in range(1, len(s))):
            continue
        clean, toxic = stems[s]
        family = {w: sum(n) for w, n in words.items() if w.startswith(s)}
        whole = s
        while len(whole) < STEM_MAX:
            share: Counter = Counter()
            for w, n in family.items():
                share[w[:len(whole) + 1]] += n
            longer, n = share.most_common(1)[0] if share else ("", 0)
            if len(longer) <= len(whole) or n < 0.99 * sum(family.values()):
                break
            whole = longer
        out[whole] = min(6.0, math.log((toxic + 0.5) / (clean + 0.5)) - math.log(prior / (1 - prior)))
        taken.update(whole[:n] for n in range(1, len(whole) + 1))
    return out


def fit_score(x: np.ndarray, y: np.ndarray, n: np.ndarray, cap: float = 12.0) -> tuple[float, float]:
    """(bias, scale) of a logistic curve through (weight, toxic, number of texts), by damped
    Newton steps, drawn slightly towards the default curve."""
    a = np.stack([np.ones(len(x)), np.minimum(x, cap)], axis=1)
    prior, pull = np.array([-4.0, 1.0]), np.diag([0.05, 0.5])

    def loss(beta):
        z = a @ beta
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + (beta - prior) @ pull @ (beta - prior) / 2)

    beta = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ beta))
        grad = a.T @ (n * (p - y)) + pull @ (beta - prior)
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + pull, grad)
        t = 1.0
        while t > 1e-6 and loss(beta - t * step) > loss(beta):
            t /= 2
        beta = beta - t * step
        if np.abs(t * step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0.05, beta[1]))


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Lexicon and score curve from labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    known = (pick(labels, ["doc_id", "toxic"], "labels").where("toxic is not null and doc_id is not null")
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = known.count()
    if not n:
        return Model()
    share = min(1.0, max_train_docs / n)
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
                         < F.lit(int(share * 1_000_000)))
    rows = written(pick(docs, ["doc_id", "text"], "docs").join(sample, "doc_id")
                   .select(text_or_empty().alias("text"), "toxic").distinct(), "tox-train")
    size = {r["toxic"]: r["n"] for r in
            rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return Model()
    prior = size[1] / (size[0] + size[1])
    rows = rows.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    stems = (rows.mapInArrow(lean(_count_stems), "stem string, toxic int, n long")
             .groupBy("stem").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                                  F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
             .where("a >= 4 and b <= a"))
    # bounded by the sample: candidate stems and their words come from max_train_docs texts
    shared = spark.sparkContext.broadcast({r["stem"] for r in stems.select("stem").toLocalIterator()})
    seen = (rows.mapInArrow(lean(_evidence(shared)), "item string, toxic int, sketch long")
            .distinct().groupBy("item")
            .agg(F.sum(1 - F.col("toxic")).alias("b"), F.sum("toxic").alias("a")))
    counts = {r["item"]: (r["b"], r["a"]) for r in seen.toLocalIterator()}
    by_word = {k[1:]: v for k, v in counts.items() if k[0] == "="}
    by_stem = {k: v for k, v in counts.items() if k[0] != "="}
    model = Model(stems=choose_stems(by_stem, by_word, prior))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [round(model.weigh(t), 3) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b.column("toxic")], ["x", "toxic"])

    got = (rows.mapInArrow(lean(weigh), "x double, toxic int").groupBy("x", "toxic").count()
           .orderBy("x", "toxic").collect())              # at most max_train_docs rows
    model.bias, model.scale = fit_score(*(np.array([r[c] for r in got], dtype=float)
                                          for c in ("x", "toxic", "count")))
    return model


def _scored(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """Every row's columns as ``in_0, in_1, ...``, ``score`` and ``predicted``."""
    require_columns(docs, ["text"], "docs")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, IntegerType, StructType
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = docs.select(*numbered(docs), text_or_empty(docs["text"]).alias("text"))
    out = StructType(list(inner.schema.fields[:-1])).add("score", DoubleType()).add("predicted", IntegerType())
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(t) for t in b.column("text").to_pylist()]
            cols = [c.cast(t) if not c.type.equals(t) else c
                    for c, t in zip(b.columns[:-1], arrow.types)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())],
                schema=arrow)

    return inner.mapInArrow(lean(run), out)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` added; columns that
    ``docs`` has under these names are replaced."""
    kept = [x for x, c in zip(renamed(docs.columns), docs.columns) if c.lower() not in ("score", "predicted")]
    return _scored(docs, model, threshold).select(*kept, "score", "predicted")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    scored = _scored(docs, fit(docs, labels), threshold)
    return scored.where("predicted = 0").select(*renamed(docs.columns))
