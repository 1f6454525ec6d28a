"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of its documents' tokens.  In every round each source's deficit
counter grows by its quantum, its target share of ``ROUND`` tokens, and the source sends
chunks (``CHUNK`` tokens or a document's last few) while the counter covers them; what is left
of the counter is carried on.  The stream of chunks is cut into windows of ``capacity``
tokens, so a window holds every source's target share up to about a chunk, and what it lacks
the next windows make up.

Over many partitions: a chunk's virtual time is its place in its queue over the source's weight,
so the chunks of a stretch of virtual time are one segment of about ``SEGMENT`` tokens, with
every source's share in it.  A segment's task starts with the deficits that the segments
before leave: the tokens a source should have sent by then, less those it has.  The tokens of the
segments before fix where its windows begin, and a window may span two segments.  The round in
which a chunk goes follows from its place in the queue, the deficit and the quantum, so a
task only sorts.

Targets are the sources' shares of all tokens, which every window can meet; given weights
are met until a source runs out, whose share then falls to the others by weight.  The rest
behind the last whole window is cut into powers of two, which need no padding.

Work and memory: one pass of tokenization, the ids are written once and shuffled once by segment;
a segment is bounded however hot a source is.  Sources start at a phase of their own
(by hash), so even a million sources of one chunk each are spread over all segments.  Order within
a source is that of the table's rows.

Defined results: a null or empty text is the end id alone; a null source is a source like
any other; repeated rows are documents of their own; a null ``doc_id`` is kept; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import lean, pick, text_or_empty, written
from martlight.llm.tokens import crc_u32, open_tokenizer

CAPACITY = 4096
CHUNK = 256               # most tokens sent at a time
ROUND = 1024              # tokens of all sources' quanta
SEGMENT = 1 << 20         # tokens of a segment, about
GROUP = 1024              # segments whose starts are summed at a time
FLUSH = 1 << 20           # tokens a tokenizing task holds


def queued(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """part, seq, doc_id, source, n, ids (little-endian, ``width`` bytes each), width and q (the
    tokens of the same source before it in the task) of every row."""
    ddl = "part int, seq long, doc_id long, source string, n long, q long, width int, ids binary"
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = [f.split()[0] for f in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        tok = open_tokenizer(tokenizer, kind)
        end = np.array([end_id], tok.dtype).tobytes()
        sent: dict[str | None, int] = {}                 # tokens so far by source
        for b in batches:
            rows, held = [], 0
            texts = (t.as_py() for t in b.column("text"))
            for doc, source, raw in zip(b.column("doc_id").to_pylist(), b.column("source").to_pylist(),
                                        tok.batches(texts)):
                n = len(raw) // tok.width + 1
                q = sent.get(source, 0)
                sent[source] = q + n
                rows.append((part, seq, doc, source, n, q, tok.width, raw + end))
                seq += 1
                held += n
                if held > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return written(pick(docs, ["doc_id", "text", "source"], "docs")
                   .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                           text_or_empty().alias("text")).mapInArrow(lean(run, "tokens"), ddl), "mixture-ids")


def _served(weights: list[tuple[float, float]], time: Column) -> Column:
    """Tokens that (weight, tokens) sources have sent by a virtual time."""
    each = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t")) for w, t in weights])
    return F.aggregate(each, F.lit(0.0), lambda a, x: a + F.least(x["w"] * time, x["t"]))


def _time_of(weights: list[tuple[float, float]], served: np.ndarray) -> np.ndarray:
    """The virtual times by which so many tokens are sent."""
    ends = np.array(sorted({0.0} | {t / w for w, t in weights}))
    at = np.array([sum(min(w * v, t) for w, t in weights) for v in ends])
    return np.interp(served, at, ends)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, kind: str = "words",
         targets: Mapping[str | None, float] | None = None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and source of every piece.

    ``targets``: a weight above zero for every source (None for the null source)."""
    rows = queued(docs, tokenizer, end_id, kind)
    per_part = rows.groupBy("source", "part").agg(F.sum("n").alias("tokens"))
    before = Window.partitionBy("source").orderBy("part")
    starts = per_part.select("source", "part", (F.sum("tokens").over(before) - F.col("tokens")).alias("start"))
    totals = written(per_part.groupBy("source").agg(F.sum("tokens").alias("total")), "mixture-sources")
    total = totals.agg(F.sum("total")).first()[0] or 0
    segments = max(1, -(-total // segment))
    if targets is None:
        known = totals.withColumn("weight", F.col("total").cast("double"))
        fixed = [(float(total), float(total))]
    else:
        given = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in targets.items()],
                                                  "source string, weight double")
        known = written(totals.join(given, totals["source"].eqNullSafe(given["source"]), "left")
                        .select(totals["source"], "total", "weight"), "mixture-targets")
        if not known.where("weight is null or weight <= 0").isEmpty():
            raise ValueError("every source needs a target weight above zero")
        # one row per entry of ``targets``
        fixed = [(r["weight"], float(r["total"])) for r in known.select("weight", "total").collect()]
    # one row per task and source: where its tokens begin in the source's queue
    begins = written(
        starts.select(F.col("source").alias("name"), F.col("part").alias("p"), "start")
        .join(known.select(F.col("source").alias("s"), "weight"), F.col("name").eqNullSafe(F.col("s")))
        .select("name", "p", "start", "weight"), "mixture-begins")

    # chunks: place c in the document; virtual time by a phase of the source's own
    phase = F.shiftrightunsigned(F.xxhash64("source", F.lit(7)), 11) / float(1 << 53)
    size = F.least(F.lit(CHUNK).cast("long"), F.col("n") - F.col("c"))
    share = _served(fixed, (F.col("at") + phase * F.col("size")) / F.col("weight")) / float(max(1, total))
    which = F.least(F.floor(share * segments), F.lit(segments - 1)).cast("long")

    def chunks(cols: list[str]) -> DataFrame:
        """The chunks of all documents with the columns ``cols`` of these."""
        return (rows.select(*{"part", "source", "n", "q", *cols})
                .join(begins, F.col("source").eqNullSafe(F.col("name")) & (F.col("part") == F.col("p")))
                .withColumn("c", F.explode(F.expr(f"sequence(0L, n - 1, {CHUNK}L)")))
                .withColumn("size", size).withColumn("at", F.col("start") + F.col("q") + F.col("c"))
                .withColumn("segment", which))

    # the tokens before each segment, summed group by group
    sums = written(chunks([]).groupBy("segment").agg(F.sum("size").alias("tokens"))
                   .withColumn("g", F.expr(f"segment div {GROUP}")), "mixture-segments")
    groups = sums.groupBy("g").agg(F.sum("tokens").alias("all"))      # one row per GROUP segments
    groups = groups.select(F.col("g"), (F.sum("all").over(Window.orderBy("g")) - F.col("all")).alias("base"))
    inside = F.sum("tokens").over(Window.partitionBy("g").orderBy("segment")) - F.col("tokens")
    first = (sums.withColumn("inside", inside).join(groups, "g")
             .select("segment", (F.col("base") + F.col("inside")).alias("first")))

    # the ids are shuffled once, by segment; a segment's own row, with its first place, leads it
    ids = F.expr("substring(ids, cast(c * width + 1 as int), cast(size * width as int))")
    dealt = (chunks(["seq", "doc_id", "width", "ids"])
             .select("segment", F.lit(None).cast("long").alias("first"), "source", "weight", "part", "seq", "doc_id",
                     F.col("n").alias("doc_tokens"), "c", "size", "at", "width", ids.alias("ids"))
             .unionByName(first, allowMissingColumns=True))
    return (dealt.repartition("segment")
            .sortWithinPartitions("segment", F.col("first").asc_nulls_last(), "source", "at")
            .mapInArrow(lean(_segment_task(capacity, total, segments, fixed)),
                        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                        "offset long, source string"))


def _order(source: np.ndarray, weight: np.ndarray, end: np.ndarray, begun: float) -> np.ndarray:
    """The order in which deficit round-robin sends the chunks of a segment.

    ``source``: number of each chunk's source, ``end``: the place in its queue behind the chunk,
    ``begun``: the segment's first virtual time.  The deficit a source brings along is what it
    should have sent by then, ``begun * weight``, less what it has; so a chunk goes in the first
    round whose quanta cover ``end - begun * weight``, and sources take turns within a round."""
    names, at = np.unique(source, return_index=True)
    quantum = ROUND * weight / weight[at].sum()
    turn = np.maximum(0, np.ceil((end - begun * weight) / quantum))
    return np.lexsort((end, source, turn))


def windows(total: int, capacity: int) -> list[int]:
    """Starts of the sequences behind the last whole window: powers of two."""
    at, rest = total - total % capacity, total % capacity
    out = []
    while rest:
        out.append(at)
        at += 1 << (rest.bit_length() - 1)
        rest -= 1 << (rest.bit_length() - 1)
    return out


def _segment_task(capacity: int, total: int, segments: int, fixed: list[tuple[float, float]]):
    tail = windows(total, capacity)
    whole = total // capacity

    def sequence(at: int) -> tuple[int, int, int]:
        """Number, start and end of the sequence that holds a place of the stream."""
        if at < whole * capacity:
            w = at // capacity
            return w, w * capacity, (w + 1) * capacity
        i = int(np.searchsorted(tail, at, "right")) - 1
        return whole + i, tail[i], tail[i + 1] if i + 1 < len(tail) else total

    types = [pa.int64()] * 7 + [pa.string()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]

    def sent(t: pa.Table) -> pa.RecordBatch:
        """The pieces of one segment, whose first row has its place in the stream."""
        place = t.column("first")[0].as_py()
        t = t.slice(1)
        col = {c: t.column(c).to_numpy() for c in
               ("segment", "weight", "part", "seq", "doc_tokens", "c", "size", "at", "width")}
        doc, sources, raw = (t.column(c).to_pylist() for c in ("doc_id", "source", "ids"))
        number: dict = {}
        source = np.array([number.setdefault(s, len(number)) for s in sources])
        begun = float(_time_of(fixed, np.array([col["segment"][0] * (total / segments)]))[0])
        order = _order(source, col["weight"], col["at"] + col["size"], begun)
        dtype = np.dtype(f"<u{int(col['width'][0])}")
        pieces: list[list] = []
        key = None                              # the piece that may go on: row, next id, sequence
        for i in order.tolist():
            ids = np.frombuffer(raw[i], dtype)
            done, row = 0, (col["part"][i], col["seq"][i])
            while done < len(ids):
                w, lo, hi = sequence(place)
                n = min(len(ids) - done, hi - place)
                start = int(col["c"][i]) + done
                if key == (row, start, w):
                    pieces[-1][2] += n
                    pieces[-1][3].append(ids[done:done + n])
                else:
                    pieces.append([doc[i], start, n, [ids[done:done + n]], int(col["doc_tokens"][i]), w, place - lo,
                                   sources[i]])
                key = (row, start + n, w)
                done += n
                place += n
        for p in pieces:
            p[3] = crc_u32(np.concatenate(p[3]))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            s = b.column("segment").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
            for i, j in zip(cuts, cuts[1:]):
                if s[i] != now and held:
                    yield sent(pa.Table.from_batches(held))
                    held = []
                now = s[i]
                held.append(b.slice(i, j - i))
        if held:
            yield sent(pa.Table.from_batches(held))
    return run
