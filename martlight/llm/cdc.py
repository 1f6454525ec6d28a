"""Substring dedup by content-defined chunking.

A gear rolling hash over the last ``WINDOW`` bytes cuts every text where the hash
falls below a threshold, so cuts move with the content: text inserted before a
passage shifts its chunks but does not change them.  What is compared by digest over
the whole corpus is groups: the chunks from each one on up to ``MIN_WORDS`` whole words.
A group repeats if an earlier row (smaller ``doc_id``) has the same one, so the whole
passage stands there.  Groups that follow each other are one run only if an earlier row
holds both in this order; a group that is not linked so starts a run of its own behind
the last one.  Runs are cut out of the later row, at word ends, so every ``MIN_WORDS``
words in a row that go with one cut stand in an earlier row.  The row with the smallest
``doc_id`` keeps the passage.

The minimum per digest combines in the map tasks; the join back is between two
written tables, whose large partitions adaptive execution splits, so a chunk held
by a third of the corpus is no single task.  Every row is written with a number of
its own, by which chunks and spans are kept.  What is grouped is the spans of one
row, bounded by its own text.

Defined results: a null text stays null and an empty one empty; a repeat within one row
is left; rows that share a ``doc_id`` come in the order of their numbers, each a text of
its own; rows with a null ``doc_id`` come last, likewise; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import lean, numbered, renamed, require_columns, text_or_empty, written

WINDOW = 16               # bytes a cut depends on
MIN_CHUNK = 12            # bytes
MEAN_GAP = 24             # mean bytes between cut candidates
MAX_CHUNK = 96            # bytes
MIN_WORDS = 20            # whole words of a run that is cut out
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)

_STEP = 10 ** 19          # order of rows: doc_id * _STEP + row number, as decimal(38, 0)
_SPACE = frozenset(b" \t\n\v\f\r")
_BASE = 0x9E3779B97F4A7C15          # odd: digests of chunk sequences are polynomials mod 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: sum of GEAR[b] << 2*age over WINDOW bytes."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        older = np.zeros_like(h)
        older[step:] = h[:-step] if step < len(h) else 0
        h = h + (older << np.uint32(2 * step))
        step *= 2
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the chunks of ``text``; the last is its length."""
    n = len(text)
    h = rolling(np.frombuffer(text, np.uint8))
    cuts = np.flatnonzero(h < (1 << 32) // MEAN_GAP) + 1
    ends: list[int] = []
    last = 0
    for c in [*cuts.tolist(), n]:
        while c - last > MAX_CHUNK:
            # the last least hash in reach: a monotonous run is cut at one phase too
            reach = h[last + MIN_CHUNK - 1:last + MAX_CHUNK]
            last += MIN_CHUNK + len(reach) - 1 - int(reach[::-1].argmin())
            ends.append(last)
        if c - last >= MIN_CHUNK or (c == n and c > last):
            ends.append(c)
            last = c
    return ends


def groups(raw: bytes, min_words: int) -> tuple[np.ndarray, ...]:
    """digest, start, size and size of the first chunk of the group at every chunk: the least
    chunks from there on that hold ``min_words`` whole words.  Where too few follow, none."""
    import xxhash
    digest = xxhash.xxh3_64_intdigest
    ends = chunk_ends(raw)
    starts = np.array([0, *ends[:-1]] if ends else [], np.int64)
    stops = np.array(ends, np.int64)
    data = np.frombuffer(raw, np.uint8)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)       # of the words
    need = np.searchsorted(first, starts) + max(min_words, 1) - 1
    n = int(np.searchsorted(need, len(last)))             # groups: chunks with words enough behind
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    to = np.searchsorted(stops, last[need[:n]])           # its last chunk
    d = np.array([digest(raw[i:j]) for i, j in zip(starts.tolist(), ends)], np.uint64)
    down, up = np.full(len(d), _INVERSE, np.uint64), np.full(len(d), _BASE, np.uint64)
    down[0] = up[0] = 1
    down, up = np.cumprod(down, dtype=np.uint64), np.cumprod(up, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(d * down, dtype=np.uint64)])
    at = np.arange(n)
    whole = (total[to + 1] - total[at]) * up[:n] + (to + 1 - at).astype(np.uint64)
    return whole.view(np.int64), starts[:n], stops[to] - starts[:n], stops[:n] - starts[:n]


def _group_task(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            # one text at a time
            for doc, row, text in zip(b.column("doc_id").to_pylist(), b.column("row").to_pylist(), b.column("text")):
                found = groups(text.as_py().encode(), min_words)
                if len(found[0]):
                    held.append((doc, row, found))
                    size += len(found[0])
                if size > 200_000:
                    yield _group_batch(held)
                    held, size = [], 0
            if held:
                yield _group_batch(held)
    return run


def _group_batch(held: list) -> pa.RecordBatch:
    each = [len(f[0]) for _, _, f in held]
    ids = pa.array([doc for doc, _, _ in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), each)))
    digest, at, size, step = (np.concatenate([f[i] for _, _, f in held]) for i in range(4))
    return pa.RecordBatch.from_arrays(
        [pa.array(digest), ids, pa.array(np.repeat([row for _, row, _ in held], each)),
         pa.array(at.astype(np.int32)), pa.array(size << 8 | step)], ["digest", "doc_id", "row", "at", "reach"])


def _order():
    """One number that orders the rows by (doc_id nulls last, row)."""
    step = F.lit(Decimal(_STEP))
    return F.coalesce(F.col("doc_id").cast("decimal(19,0)") * step + F.col("row"),
                      F.lit(Decimal(1 << 63)) * step + F.col("row")).cast("decimal(38,0)")


def chunk_groups(rows: DataFrame, min_words: int) -> DataFrame:
    """digest, doc_id, row, at and reach (bytes * 256 + bytes of the first chunk) of every group."""
    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), "row", text_or_empty().alias("text"))
            .mapInArrow(lean(_group_task(min_words)), "digest long, doc_id long, row long, at int, reach long"))


def _first_holders(found: DataFrame, key: str, name: str) -> DataFrame:
    """``key`` and the ``first`` row of what more than one row holds."""
    held = (found.groupBy(key).agg(F.min(_order()).alias("first"), F.max(_order()).alias("last"))
            .where("first < last"))
    return written(held.select(key, F.pmod("first", F.lit(Decimal(_STEP))).cast("long").alias("first")), name)


def repeated_groups(found: DataFrame) -> DataFrame:
    """row, at, size of the groups that an earlier row holds too, and ``linked``: an earlier
    row holds the group and the next one after it."""
    held = found.join(_first_holders(found, "digest", "cdc-first"), "digest")
    by = Window.partitionBy("row").orderBy("at")
    held = written(
        held.withColumn("then", F.lead(F.struct("at", "digest")).over(by))
        .select("doc_id", "row", "at", F.expr("reach div 256").alias("size"), (F.col("row") != F.col("first")).alias("later"),
                F.when(F.col("then.at") == F.col("at") + F.col("reach") % 256,
                       F.xxhash64("digest", "then.digest")).alias("link")), "cdc-held")
    firsts = _first_holders(held.where("link is not null"), "link", "cdc-links").withColumnRenamed("first", "owner")
    later = held.where("later")
    # what has no link joins nothing, dealt by row and place
    return (later.withColumn("link", F.coalesce("link", F.xxhash64(F.lit("none"), "row", "at")))
            .join(firsts, "link", "left")
            .select("row", "at", "size", F.coalesce(F.col("row") != F.col("owner"), F.lit(False)).alias("linked")))


def cut_runs(raw: bytes, spans: list[tuple[int, int, bool]], min_words: int) -> list[tuple[int, int]]:
    """Byte ranges to cut: runs of linked (at, size, linked to the next) spans, shrunk to
    whole words, with ``min_words`` words or more."""
    runs: list[list[int]] = []
    goes_on = False
    for at, size, linked in sorted(spans):
        if goes_on:
            runs[-1][1] = max(runs[-1][1], at + size)
        elif not runs or runs[-1][1] <= at:
            runs.append([at, at + size])
        else:
            continue
        goes_on = linked
    out = []
    n = len(raw)
    for a, b in runs:
        b = min(b, n)
        while 0 < a < b and raw[a - 1] not in _SPACE:      # inside a word: to the next
            a += 1
        while b < n and b > a and raw[b] not in _SPACE:
            b -= 1
        if b > a and len(raw[a:b].split()) >= min_words:
            out.append((a, b))
    return out


def _cut(docs: DataFrame, min_words: int) -> DataFrame:
    """Every row's columns as ``in_0, in_1, ...`` with the text cut, ``removed``, ``n_removed``."""
    require_columns(docs, ["doc_id", "text"], "docs")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, LongType, StructType
    cols = docs.columns
    keyed = written(docs.select(*numbered(docs, cols), F.monotonically_increasing_id().alias("row")), "cdc-rows")
    named = {c.lower(): f"in_{i}" for i, c in enumerate(cols)}
    found = written(chunk_groups(keyed.select(F.col(named["doc_id"]).alias("doc_id"), "row",
                                        F.col(named["text"]).alias("text")), min_words), "cdc-groups")
    spans = written(repeated_groups(found).groupBy("row")
                    .agg(F.collect_list(F.struct("at", "size", "linked")).alias("spans")), "cdc-spans")
    span = StructType().add("start", LongType()).add("end", LongType())
    out = (StructType(list(keyed.schema.fields[:-1]))
           .add("removed", ArrayType(span, False)).add("n_removed", LongType()))
    arrow = to_arrow_schema(out)
    where = [c.lower() for c in cols].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(where).to_pylist()
            removed, n_removed = [], []
            spans = b.column(len(cols))
            given, offsets = spans.is_valid().to_numpy(zero_copy_only=False), spans.offsets.to_numpy()
            parts = [spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "size", "linked")]
            for i in range(b.num_rows):
                cuts = []
                lo, hi = offsets[i], offsets[i + 1]
                if given[i] and hi > lo and texts[i]:
                    raw = texts[i].encode()
                    kept, last = [], 0
                    for a, z in cut_runs(raw, [*zip(*(x[lo:hi].tolist() for x in parts))], min_words):
                        lo = len(raw[:a].decode())
                        cuts.append({"start": lo, "end": lo + len(raw[a:z].decode())})
                        kept.append(raw[last:a])
                        last = z
                    texts[i] = b"".join([*kept, raw[last:]]).decode() if cuts else texts[i]
                removed.append(cuts)
                n_removed.append(sum(c["end"] - c["start"] for c in cuts))
            data = [pa.array(texts, arrow.types[j]) if j == where else
                    (c.cast(t) if not c.type.equals(t) else c)
                    for j, (c, t) in enumerate(zip(b.columns[:-1], arrow.types))]
            yield pa.RecordBatch.from_arrays(
                [*data, pa.array(removed, arrow.types[-2]), pa.array(n_removed, pa.int64())], schema=arrow)

    return (keyed.join(spans, "row", "left")
            .select(*[f"in_{i}" for i in range(len(cols))], "spans").mapInArrow(lean(run), out))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` with its ``text`` cut, and ``removed`` (array of start and
    end in characters of the former text) and ``n_removed`` (characters) added; columns
    that ``docs`` has under these names are replaced."""
    cols = docs.columns
    kept = [x for x, c in zip(renamed(cols), cols) if c.lower() not in ("removed", "n_removed")]
    return _cut(docs, min_words).select(*kept, "removed", "n_removed")


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` after the cut, with their own columns; ``n_chars``, if any, is
    counted anew where the text changed.  A document that is nothing but repeats goes."""
    cols = docs.columns
    text = F.col(f"in_{[c.lower() for c in cols].index('text')}")
    cut = _cut(docs, min_words)
    left = cut.where((F.col("n_removed") == 0) | text.rlike(r"[^\x20\x09-\x0D]"))
    counted = [F.when(F.col("n_removed") > 0, F.char_length(text).cast(docs.schema[c].dataType))
               .otherwise(F.col(f"in_{i}")).alias(f"in_{i}") if c.lower() == "n_chars" else F.col(f"in_{i}")
               for i, c in enumerate(cols)]
    return left.select(*counted).select(*renamed(cols))
