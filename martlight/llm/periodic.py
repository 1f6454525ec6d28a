"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least ``EXPONENT``
times q words (and ``MIN_LENGTH``) that no neighbouring word extends.  They are found
scale by scale, for tau = ``FIRST_SCALE``, twice that, and so on:

* a position is synchronising if, among the blocks of tau words that begin at it or up to
  tau words later, the first or the last has the least hash.  The choice depends on the next
  2 * tau words only, so equal contexts choose alike, wherever they stand;
* blocks inside highly periodic regions (a run of period tau/4 or less, found at a smaller
  scale) take no part in the choice, else every position there would be chosen.  Periods
  below ``FIRST_SCALE``, which no scale proposes, are read off the regions where a word
  equals the one q places on;
* a synchronising position and the next one with an equal context propose their distance
  as a period.  Every run with tau <= q < 2 * tau has such a pair: its first tau places
  hold a synchronising position, as a stretch of 3 * tau words of it cannot have a period of
  tau/4 too, and the same position one period on is chosen alike;
* a proposal is extended word by word in both directions, so what is returned is exact.

Texts are taken whole, many short ones at a time; a scale only looks at the texts long
enough for it.  The work is about n log n for n words and nothing is shuffled.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; a
run's words are compared as they are; repeated rows are judged alike, row by row; columns
of ``docs`` called ``runs`` or ``collapsed`` are replaced, others carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lean, numbered, renamed, require_columns, text_or_empty

EXPONENT = 4              # least length of a run, in periods
MIN_LENGTH = 6            # and in words
FIRST_SCALE = 4           # smaller periods are read off directly
BATCH_WORDS = 200_000     # words searched at a time (or one text)

_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def split_words(doc_id: int | None, text: str) -> list[bytes]:
    """The words of a text: what stands between ASCII white space."""
    return text.encode().split()


def repeat_tail(doc_id: int | None, text: str) -> list[bytes]:
    """The words of a text, every tenth of which (by the crc32 of its id) repeats a stretch
    up to its end; a text without an id is left as it is."""
    found = text.encode().split()
    n = len(found)
    if doc_id is None or not n:
        return found
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + i % p] for i in range(n - a)]


# --- runs of a sequence -----------------------------------------------------------

def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the pairs (a, b), not linear in either."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _stretches(yes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    step = np.diff(np.concatenate([[0], yes.view(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _covered(n: int, starts, ends) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


def _least_ahead(x: np.ndarray, tau: int) -> np.ndarray:
    """The least of x[i] to x[i + tau] (tau a power of two), for every i that has them."""
    least = x
    step = 1
    while step < tau:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return np.minimum(least[:-1], least[1:])


def synchronising(block: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising positions, given the hash of the tau words from each place on and
    which of these blocks are highly periodic."""
    if len(block) <= tau:
        return np.zeros(0, np.int64)
    rank = np.where(periodic, _NEVER, block)
    least = _least_ahead(rank, tau)
    return np.flatnonzero(((rank[:-tau] == least) | (rank[tau:] == least)) & (least != _NEVER))


def _agree(w: np.ndarray, at: int, q: int, way: int) -> int:
    """How many places from ``at`` on (``way`` 1) or before it (-1) equal the place q later."""
    n = len(w) - q
    done, step = 0, 64
    while True:
        if way > 0:
            lo, hi = at + done, min(at + done + step, n)
        else:
            lo, hi = max(at - done - step, 0), at - done
        if hi <= lo:
            return done
        differ = w[lo:hi] != w[lo + q:hi + q]
        if differ.any():
            return done + int(np.argmax(differ if way > 0 else differ[::-1]))
        done += hi - lo
        step *= 2


def find_runs(word: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and period of all runs, by start, then period.  ``word``: numbers of the
    words of one or more texts, a number that occurs once behind each text; ``sizes``: the
    texts' numbers of words."""
    found: dict[tuple[int, int], int] = {}               # (start, end): smallest period
    for q in range(1, FIRST_SCALE):
        starts, stops = _stretches(word[:-q] == word[q:])
        for s, e in zip(starts.tolist(), stops.tolist()):
            if e - s >= (EXPONENT - 1) * q:
                found.setdefault((s, e + q), q)
    tau = FIRST_SCALE
    held = np.arange(len(word))                          # place in ``word`` of what is looked at
    sizes = sizes.astype(np.int64)
    block = _mixed(word.astype(np.uint64), np.zeros(1, np.uint64))
    width = 1
    while True:
        enough = sizes >= EXPONENT * tau
        if not enough.any():
            break
        if not enough.all():
            keep = np.repeat(enough, sizes + 1)
            # blocks are kept for every place that begins one; the last few may begin none
            keep_blocks = keep[:len(block)]
            held, block, sizes = held[keep], block[keep_blocks], sizes[enough]
            block = block[:max(0, len(held) - width + 1)]
        while width < tau:
            block = _mixed(block[:-width], block[width:]) if len(block) > width else block[:0]
            width *= 2
        part = word[held]
        calm = [(s, e) for (s, e), q in found.items() if 4 * q <= tau <= e - s]
        periodic = np.zeros(len(block), bool)
        if calm:
            lo, hi = (np.searchsorted(held, np.array(x)) for x in zip(*calm))
            inside = (lo < len(held)) & (held[np.minimum(lo, len(held) - 1)] == np.array([s for s, _ in calm]))
            periodic = _covered(len(block), lo[inside], np.minimum(hi[inside] - tau + 1, len(block)))
        chosen = synchronising(block, tau, periodic)
        chosen = chosen[chosen + 2 * tau <= len(part)]
        context = _mixed(block[chosen], block[chosen + tau])
        order = np.argsort(context, kind="stable")
        same = context[order[1:]] == context[order[:-1]]
        at = chosen[order[:-1][same]]
        period = chosen[order[1:][same]] - at
        fits = (period >= tau) & (period < 2 * tau)
        at, period = at[fits], period[fits]
        now = (0, 0, 0)
        for i in np.lexsort((at, period)).tolist():
            t, q = int(at[i]), int(period[i])
            if q == now[0] and now[1] <= t and t + q < now[2]:
                continue                                  # proposes the run just found
            s = t - _agree(part, t, q, -1)
            e = t + _agree(part, t, q, 1) + q
            now = (q, s, e)
            if e - s >= EXPONENT * q:
                start = int(held[s])
                key = (start, start + e - s)
                found[key] = min(q, found.get(key, q))
        tau *= 2
    keep = [(s, e - s, q) for (s, e), q in found.items() if e - s >= max(MIN_LENGTH, EXPONENT * q)]
    table = np.array(sorted(keep, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


# --- Spark ------------------------------------------------------------------------

_RUN = pa.struct([pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("period", pa.int64())])


def _search(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
    """``runs`` and ``collapsed`` of a few texts."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    word = np.empty(int(first[-1]), np.int64)
    for i, t in enumerate(texts):
        word[first[i]:first[i + 1] - 1] = [number.setdefault(w, len(number)) for w in t]
        word[first[i + 1] - 1] = -1 - i
    start, length, period = find_runs(word, sizes)
    of = np.searchsorted(first, start, "right") - 1
    gone = _covered(len(word), start + period, start + length)
    per_text = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])
    collapsed = []
    for i, t in enumerate(texts):
        if per_text[i + 1] > per_text[i]:
            t = [w for w, g in zip(t, gone[first[i]:].tolist() if len(texts) == 1
                                   else gone[first[i]:first[i + 1]].tolist()) if not g]
        collapsed.append(b" ".join(t).decode())
    runs = pa.ListArray.from_arrays(
        pa.array(per_text, pa.int32()),
        pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(period)], fields=list(_RUN)))
    return runs, pa.array(collapsed, pa.string())


def with_runs(docs: DataFrame, words_of: Callable[[int | None, str], list[bytes]] = split_words) -> DataFrame:
    """Every row of ``docs`` with ``runs`` (array of start, length, period in words, by start,
    then period) and ``collapsed`` (the words that no run repeats, joined by one space).

    ``words_of`` gives the words of a row from its ``doc_id`` and text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, LongType, StringType, StructType
    require_columns(docs, ["doc_id", "text"], "docs")
    cols = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    inner = docs.select(*numbered(docs, cols), F.col("doc_id").cast("long").alias("doc_id"),
                        text_or_empty().alias("text"))
    run_type = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
    out = (StructType(list(inner.schema.fields[:-2])).add("runs", ArrayType(run_type, False))
           .add("collapsed", StringType()))
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(b, at, texts):
            runs, collapsed = _search(texts)
            kept = [c.slice(at, len(texts)) for c in b.columns[:-2]]
            kept = [c if c.type.equals(t) else c.cast(t) for c, t in zip(kept, arrow.types)]
            return pa.RecordBatch.from_arrays([*kept, runs.cast(arrow.types[-2]), collapsed], schema=arrow)

        for b in batches:
            texts, size, at = [], 0, 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                texts.append(words_of(doc, text.as_py()))
                size += len(texts[-1])
                if size >= BATCH_WORDS:
                    yield done(b, at, texts)
                    at += len(texts)
                    texts, size = [], 0
            if texts:
                yield done(b, at, texts)

    return inner.mapInArrow(lean(run), out).select(*renamed(cols), "runs", "collapsed")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest one (ties: smallest start, then period), and
    SHA-256 digests of the run list and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                         F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", F.col("top.start").alias("start"), (-F.col("top.shorter")).alias("length"),
                    F.col("top.period").alias("period"),
                    F.expr("1000 * -top.shorter div top.period").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
