"""SimHash near-duplicates by pigeonring filtering.

The 64 bits form a ring of ``SEGMENTS`` segments.  If two fingerprints differ in
at most ``tau`` bits, some segment starts a chain whose cumulative differences
stay within ``l * tau / SEGMENTS`` over its first l segments, for every l.  With
5 segments and 4 bits: the first segment is equal, the first two differ in at most
1 bit, three in 2, four in 3.  The equal segment is the shuffle key; within a
bucket the second segment is looked up with each of its bits flipped; the longer
chain budgets prune what is left before the full Hamming check.

A bucket above ``BLOCK`` fingerprints is dealt as pairs of blocks, so no group of
rows exceeds two blocks.  A task returns, per bucket, a spanning forest of the
links it has verified, never the pairs of a dense group: components stay exact.

Defined results: a null or empty text has fingerprint zero and links like any
other; repeated rows share a fingerprint and so a component; a component's id is
its smallest non-null ``doc_id`` (null if it has none).  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lean, numbered, renamed, require_columns, text_or_empty, written
from martlight.llm.components import components

SHINGLE = 4
TAU = 4
SEGMENTS = 5
BLOCK = 2048              # fingerprints of one block of a large bucket
SLICE = 1 << 20           # candidate pairs checked at once


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """64-bit SimHash of the word k-shingles (repeats included); no word: 0."""
    import xxhash
    words = text.encode().lower().split()            # ASCII only, both steps
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-k].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())]
    ones = np.zeros(64, dtype=np.int64)
    h = np.array(hashes, dtype=">u8")
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, keep: list[str], k: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of every row as ``in_0, in_1, ...``, and ``fp``, the fingerprint
    as a signed long."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructType
    inner = docs.select(*numbered(docs, keep), text_or_empty(docs["text"]).alias("text"))
    out = StructType(list(inner.schema.fields[:-1])).add("fp", LongType())
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, k) for t in b.column("text").to_pylist()], dtype=np.uint64)
            cols = [c.cast(t) if not c.type.equals(t) else c
                    for c, t in zip(b.columns[:-1], arrow.types)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp.view(np.int64))], schema=arrow)

    return inner.mapInArrow(lean(run), out)


# --- links ----------------------------------------------------------------------

def _layout(segments: int) -> tuple[list[int], list[int]]:
    """Widths and offsets of the segments, the wider ones first."""
    width = [64 // segments + (i < 64 % segments) for i in range(segments)]
    return width, [sum(width[:i]) for i in range(segments)]


def _rotated(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    return np.where(by == 0, x, (x >> by) | (x << ((np.uint64(64) - by) & np.uint64(63))))


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of a[i] and b[i]; every label is its set's least index."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def forest(group: np.ndarray, start: np.ndarray, side: np.ndarray, fp: np.ndarray,
           tau: int = TAU, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (child, root) that join, within each group, the fingerprints that
    verified links connect.

    ``group``: bucket and block pair; ``start``: the bucket's first segment; ``side``:
    0 and 1 are the two blocks of a pair (only links across), 2 is a block with itself."""
    width, offset = _layout(segments)
    w, off = np.array(width), np.array(offset)
    n = len(fp)
    label = np.arange(n)
    if n < 2:
        return label[:0], label[:0]
    ring = _rotated(fp, off[start])                     # the chain starts at bit 0
    first = w[start].astype(np.uint64)
    second_w = w[(start + 1) % segments].astype(np.uint64)
    second = (ring >> first) & ((np.uint64(1) << second_w) - np.uint64(1))
    top = max(width)
    key = (group.astype(np.uint64) << np.uint64(top)) | second
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    # mask over the first l segments, by starting segment
    cover = np.zeros((segments, segments + 1), dtype=np.uint64)
    for i in range(segments):
        for l in range(1, segments + 1):
            bits = sum(width[(i + j) % segments] for j in range(l))
            cover[i, l] = (1 << bits) - 1
    budget = [l * tau // segments for l in range(segments + 1)]
    flips = [0] + ([1 << b for b in range(top)] if budget[2] >= 1 else [])
    for flip in flips:
        want = key ^ np.uint64(flip)
        lo = np.searchsorted(ordered, want, "left")
        hits = np.searchsorted(ordered, want, "right") - lo
        total = np.cumsum(hits)
        at = 0
        while at < n:
            done = total[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(total, done + SLICE, "right")))
            many = hits[at:upto]
            if many.sum():
                a = np.repeat(np.arange(at, upto), many)
                shift = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
                b = order[np.repeat(lo[at:upto], many) + shift]
                ok = (a < b) & ((side[a] == 2) | (side[a] != side[b]))
                a, b = a[ok], b[ok]
                x = ring[a] ^ ring[b]
                for l in range(3, segments + 1):         # longer chains, then all bits
                    ok = np.bitwise_count(x & cover[start[a], l]) <= budget[l]
                    a, b, x = a[ok], b[ok], x[ok]
                label = _unite(label, a, b)
            at = upto
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def _link_task(tau: int, segments: int):
    def groups(batches: Iterator[pa.RecordBatch]):
        """Runs of whole groups of about 64k rows (a group has two blocks at most)."""
        held = None
        for b in batches:
            t = [np.asarray(b.column(i)) for i in range(4)]
            held = t if held is None else [np.concatenate(p) for p in zip(held, t)]
            if len(held[0]) < 1 << 16:
                continue
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0))
            if len(new):
                cut = new[-1] + 1
                yield [c[:cut] for c in held]
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, pair, side, fp in groups(batches):
            change = np.concatenate(([0], (np.diff(bucket) != 0) | (np.diff(pair) != 0)))
            u = fp.astype(np.int64).view(np.uint64)
            child, root = forest(np.cumsum(change), (bucket >> 32).astype(np.int64), side, u,
                                 tau, segments)
            if len(child):
                yield pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root])], ["u", "v"])
    return run


def links(fps: DataFrame, tau: int = TAU, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of the distinct ``fp`` at
    ``tau`` or fewer differing bits."""
    if not 0 <= tau < segments:
        raise ValueError("tau must be below the number of segments: the first of a chain is equal")
    width, offset = _layout(segments)
    rows = fps.select(F.explode(F.array(*[
        F.struct((F.lit(i << 32) + F.shiftrightunsigned("fp", offset[i]).bitwiseAND((1 << width[i]) - 1))
                 .alias("bucket"), F.col("fp").alias("fp")) for i in range(segments)])).alias("r")
    ).select("r.*")
    sizes = written(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block),
                    "simhash-large")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = (rows.join(sizes, "bucket", "left")
             .withColumn("nb", F.coalesce(blocks, F.lit(1)))
             .withColumn("b", F.coalesce(mine, F.lit(0)))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("bucket",
                     (F.least("b", "o") * F.col("nb") + F.greatest("b", "o")).cast("long").alias("pair"),
                     F.when(F.col("b") == F.col("o"), 2).when(F.col("b") < F.col("o"), 0)
                     .otherwise(1).alias("side"), "fp"))
    return (dealt.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
            .mapInArrow(lean(_link_task(tau, segments)), "u long, v long"))


def component_of(rows: DataFrame, tau: int = TAU, segments: int = SEGMENTS) -> DataFrame:
    """(fp, component_id, root) of every distinct ``fp`` of ``rows`` (columns doc_id, fp); ``root``
    is a fingerprint that stands for the component, whatever its ids."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = written(components(links(nodes.select("fp"), tau, segments))
                    .withColumnRenamed("node", "fp"), "simhash-roots")
    rooted = written(nodes.join(roots, "fp", "left")
                     .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    return rooted.join(ids, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    require_columns(docs, ["doc_id", "text"], "docs")
    rows = written(with_fingerprints(docs, ["doc_id"], k).select(F.col("in_0").alias("doc_id"), "fp"),
                   "simhash-fp")
    found = written(component_of(rows, tau), "simhash-components")
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, k: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """One row of every component: that of the smallest doc_id (null ids last), then
    of the smallest fingerprint; of repeated rows of that document, one."""
    require_columns(docs, ["doc_id", "text"], "docs")
    cols = docs.columns
    key = f"in_{[c.lower() for c in cols].index('doc_id')}"
    rows = written(with_fingerprints(docs, cols, k), "simhash-docs")
    ids = rows.select(F.col(key).alias("doc_id"), "fp")
    found = written(component_of(ids, tau), "simhash-components")
    least = ids.groupBy("fp").agg(F.min("doc_id").alias("least"))
    best = (found.join(least, "fp").where("least <=> component_id")
            .groupBy("root").agg(F.min("fp").alias("fp"), F.min("component_id").alias("component_id"))
            .select(F.col("component_id").alias("keep_id"), "fp"))
    best = written(best, "simhash-kept")
    at = rows.alias("r").join(best.alias("b"), (F.col("r.fp") == F.col("b.fp"))
                              & F.col(f"r.{key}").eqNullSafe(F.col("b.keep_id")), "left_semi")
    return at.dropDuplicates([key, "fp"]).select(*renamed(cols))
