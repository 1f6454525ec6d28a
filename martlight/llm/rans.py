"""Token-id files: static range asymmetric numeral coding (rANS).

Every document is tokenized, ended with the end id and written, in ascending
``doc_id`` order, as independent blocks of whole documents.  A block interleaves
``LANES`` rANS states over one stream of 32-bit words; all blocks share one
frequency table gathered from the whole corpus.  Each block keeps

* checkpoints: the lane states and the word position before every
  ``CHECK_STEPS``-th step, so any part of a block decodes on its own;
* crc32 checksums of its words and of its decoded ids.

File format (a folder; every table is Parquet, committed by Spark's writer, so
a task that runs again never leaves half a file):

``table/``   token, freq: frequencies that sum to ``2**PROB_BITS``
``blocks/``  part, doc_ids, lens, tok_before, n_tokens, words, states,
             marks, words_crc32, ids_crc32 (binary columns are little-endian)
``parts/``   part, start: ids in all earlier parts

Parts are ranges of ascending ``doc_id``; rows of one ``doc_id`` stay together,
ordered by text.  A null ``doc_id`` sorts first, a null text is empty (its
document is the end id alone).  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.llm.common import fresh_dir, lean, pick, text_or_empty, written
from martlight.llm.tokens import crc_u32, open_tokenizer

LANES = 512               # interleaved states per block
PROB_BITS = 20            # frequencies sum to 2**20
LOW = np.uint64(1 << 31)  # states stay in [2**31, 2**63)
BLOCK_TOKENS = 1 << 17    # a block closes at the first document end beyond this
CHECK_STEPS = 128         # steps between checkpoints

_U32 = np.uint64(32)
_BITS = np.uint64(PROB_BITS)
_MASK = np.uint64((1 << PROB_BITS) - 1)


class CorruptBlock(ValueError):
    """A block whose checksum does not match its content."""


# --- the coder ------------------------------------------------------------------

def scale_frequencies(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positive integers proportional to ``counts`` that sum to ``2**PROB_BITS``.

    Every token seen gets at least 1; the remainder goes to (or comes from) the
    most frequent tokens, ties to the smaller token."""
    total = int(counts.sum())
    size = 1 << PROB_BITS
    if len(counts) > size:
        raise ValueError(f"{len(counts)} distinct tokens do not fit {PROB_BITS} bits")
    if not len(counts):
        return np.zeros(0, dtype=np.int64)
    freq = np.maximum(1, counts.astype(np.float64) / total * size).astype(np.int64)
    order = np.lexsort((tokens, -counts))
    rest = size - int(freq.sum())
    while rest:
        if rest > 0:
            freq[order[0]] += rest
            rest = 0
        else:
            room = freq[order] - 1
            take = np.minimum(room, np.maximum(0, -rest - (np.cumsum(room) - room)))
            freq[order] -= take
            rest = size - int(freq.sum())
    return freq


class Table:
    """Shared frequencies, their prefix sums and the slot lookup."""

    def __init__(self, tokens: np.ndarray, freq: np.ndarray):
        top = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(top, dtype=np.uint64)
        self.freq[tokens] = freq
        self.base = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32),
                                    self.freq.astype(np.int64))
        return self._slots


def encode(ids: np.ndarray, t: Table) -> tuple[bytes, bytes, bytes]:
    """(words, states before the first step, marks) of one block.

    Step s codes ids ``s*LANES ..``; coding runs backwards so that decoding runs
    forwards.  ``marks`` holds, for every CHECK_STEPS-th step after the first,
    the word position (u64) followed by the lane states (u64)."""
    n = len(ids)
    steps = -(-n // LANES)
    x = np.full(LANES, LOW, dtype=np.uint64)
    out: list[np.ndarray] = []
    kept: list[tuple[int, int, np.ndarray]] = []
    written_words = 0
    f_all, b_all = t.freq[ids], t.base[ids]
    cap = np.uint64(63 - PROB_BITS)
    for s in range(steps - 1, -1, -1):
        lo, hi = s * LANES, min(n, (s + 1) * LANES)
        f, b, y = f_all[lo:hi], b_all[lo:hi], x[:hi - lo]
        full = y >= (f << cap)
        if full.any():
            out.append(y[full].astype("<u4"))
            written_words += int(full.sum())
            y = np.where(full, y >> _U32, y)
        q = y // f
        x[:hi - lo] = (q << _BITS) + (y - q * f) + b
        if s % CHECK_STEPS == 0 and s:
            kept.append((s, written_words, x.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, dtype="<u4")
    marks = b"".join(np.concatenate(([np.uint64(len(words) - w)], st)).astype("<u8").tobytes()
                     for _, w, st in reversed(kept))
    return words.tobytes(), x.astype("<u8").tobytes(), marks


def decode(words: bytes, states: bytes, marks: bytes, n: int, t: Table,
           first: int = 0, last: int | None = None) -> np.ndarray:
    """ids ``first .. last`` of a block of ``n``; starts at the nearest checkpoint."""
    last = n if last is None else min(last, n)
    w = np.frombuffer(words, dtype="<u4").astype(np.uint64)
    x = np.frombuffer(states, dtype="<u8").astype(np.uint64)
    s, pos = 0, 0
    back = first // LANES // CHECK_STEPS
    if back:
        m = np.frombuffer(marks, dtype="<u8").reshape(-1, LANES + 1)[back - 1]
        s, pos, x = back * CHECK_STEPS, int(m[0]), m[1:].astype(np.uint64)
    begin = s * LANES
    out = np.empty(max(0, last - begin), dtype=np.uint32)
    slots, freq, base = t.slots, t.freq, t.base
    while s * LANES < last:
        lo, hi = s * LANES, min(n, (s + 1) * LANES)
        y = x[:hi - lo]
        slot = y & _MASK
        sym = slots[slot]
        y = freq[sym] * (y >> _BITS) + slot - base[sym]
        low = y < LOW
        k = int(low.sum())
        if k:
            y[low] = (y[low] << _U32) | w[pos:pos + k]
            pos += k
        x[:hi - lo] = y
        upto = min(hi, last)
        out[lo - begin:upto - begin] = sym[:upto - lo]
        s += 1
    return out[first - begin:]


# --- writing --------------------------------------------------------------------

_IDS = ("part int, seq long, doc_id long, tok_before long, n_tokens long, ids binary, "
        "counts binary")       # counts: of a part's last row only, its ids by frequency
_BLOCK = ("part int, first_seq long, n_docs int, doc_ids binary, no_id binary, lens binary, "
          "tok_before long, n_tokens long, words binary, states binary, marks binary, "
          "words_crc32 long, ids_crc32 long")


def _arrow(ddl: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def _tokenize(path: str, kind: str, end_id: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        tok = open_tokenizer(path, kind)
        end = np.array([end_id], dtype=tok.dtype).tobytes()
        total = np.zeros(1 << 16, dtype=np.int64)
        seq = before = 0

        def sent(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for b in batches:
            docs = b.column("doc_id").to_pylist()
            rows: list = []
            size = 0
            for doc, ids in zip(docs, tok.batches(b.column("text").to_pylist())):
                ids += end
                n = len(ids) // tok.width
                rows.append((part, seq, doc, before, n, ids, None))
                seq, before, size = seq + 1, before + n, size + len(ids)
                if size > 4 << 20 or seq % 20_000 == 0:
                    total = _counted(total, rows, tok.dtype)
                    yield sent(rows)
                    rows, size = [], 0
            if rows:
                total = _counted(total, rows, tok.dtype)
                yield sent(rows)
        if seq:
            seen = np.flatnonzero(total)
            yield sent([(part, seq, None, before, 0, b"",
                         np.stack([seen, total[seen]]).astype("<i8").tobytes())])
    return run


def _counted(total: np.ndarray, rows: list, dtype: np.dtype) -> np.ndarray:
    c = np.bincount(np.frombuffer(b"".join(r[5] for r in rows), dtype=dtype), minlength=len(total))
    c[:len(total)] += total
    return c


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counts of a task's parts before they are shuffled."""
    total = np.zeros(1 << 16, dtype=np.int64)
    for b in batches:
        for v in b.column(0):
            seen, n = np.frombuffer(v.as_py(), dtype="<i8").reshape(2, -1)
            if len(seen) and seen[-1] >= len(total):
                total = np.concatenate((total, np.zeros(int(seen[-1]) + 1 - len(total), np.int64)))
            total[seen] += n
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])


def _blocks(table, width: int, schema: pa.Schema):
    def flush(docs: list) -> pa.RecordBatch:
        t = table.value
        ids = np.concatenate([np.frombuffer(d[5], dtype=f"<u{width}") for d in docs])
        words, states, marks = encode(ids, t)
        row = (docs[0][0], docs[0][1], len(docs),
               np.array([d[2] or 0 for d in docs], dtype="<i8").tobytes(),
               bytes(d[2] is None for d in docs),
               np.array([d[4] for d in docs], dtype="<i8").tobytes(),
               docs[0][3], len(ids), words, states, marks, zlib.crc32(words), crc_u32(ids))
        return pa.RecordBatch.from_arrays([pa.array([v], ty) for v, ty in zip(row, schema.types)],
                                          schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns[:6])):
                if held and (size >= BLOCK_TOKENS or row[0] != held[-1][0]
                             or row[1] != held[-1][1] + 1):
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += row[4]
        if held:
            yield flush(held)
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, kind: str = "words") -> None:
    """Write every row of ``docs`` (``doc_id``, ``text``) below ``path``."""
    spark = docs.sparkSession
    ids_schema, block_schema = _arrow(_IDS, spark), _arrow(_BLOCK, spark)
    rows = (pick(docs, ["doc_id", "text"], "docs")
            .select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")))
    # ranges of ascending doc_id, and of text where many rows share an id or have none; the
    # files written next fix them
    ordered = (rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                       F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    ids = written(ordered.mapInArrow(lean(_tokenize(tokenizer, kind, end_id, ids_schema), "tokens"), _IDS),
                  "rans-ids")
    counts = (ids.where("counts is not null").select("counts").mapInArrow(lean(_histogram), "token long, n long")
              .groupBy("token").agg(F.sum("n").alias("n")))
    # one row per token of the vocabulary: at most 2**PROB_BITS, checked when scaled
    freq = counts.orderBy("token").limit((1 << PROB_BITS) + 1).toPandas()
    tokens = freq["token"].to_numpy(np.int64)
    scaled = scale_frequencies(tokens, freq["n"].to_numpy(np.int64))
    (spark.createDataFrame([(int(a), int(b)) for a, b in zip(tokens, scaled)], "token long, freq long")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/table"))
    shared = spark.sparkContext.broadcast(Table(tokens, scaled))
    (ids.where("counts is null").mapInArrow(lean(_blocks(shared, width, block_schema)), _BLOCK)
     .write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks"))
    totals = ids.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
     .write.mode("overwrite").parquet(f"{path}/parts"))


# --- reading --------------------------------------------------------------------

def read_table_file(spark: SparkSession, path: str) -> Table:
    """The shared frequency table (one row per token of the vocabulary)."""
    pdf = spark.read.parquet(f"{path}/table").toPandas()
    return Table(pdf["token"].to_numpy(np.int64), pdf["freq"].to_numpy(np.int64))


_DECODED = "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32
    [, ids array<long>].  A damaged block raises :class:`CorruptBlock`."""
    shared = spark.sparkContext.broadcast(read_table_file(spark, path))
    ddl = _DECODED + (", ids array<long>" if with_ids else "")
    schema = _arrow(ddl, spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches:
            for r in b.to_pylist():
                if zlib.crc32(r["words"]) != r["words_crc32"]:
                    raise CorruptBlock(f"part {r['part']}, document {r['first_seq']}: words")
                ids = decode(r["words"], r["states"], r["marks"], r["n_tokens"], t)
                if crc_u32(ids) != r["ids_crc32"]:
                    raise CorruptBlock(f"part {r['part']}, document {r['first_seq']}: ids")
                lens = np.frombuffer(r["lens"], dtype="<i8")
                ends = np.cumsum(lens)
                docs = np.frombuffer(r["doc_ids"], dtype="<i8").tolist()
                docs = [None if no else d for d, no in zip(docs, r["no_id"])]
                cuts = np.split(ids, ends[:-1])
                cols = [docs, [r["part"]] * len(docs), (ends - lens + r["tok_before"]).tolist(),
                        lens.tolist(), [crc_u32(c) for c in cuts]]
                if with_ids:
                    cols.append([c.tolist() for c in cuts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, ty) for c, ty in zip(cols, schema.types)], schema=schema)

    docs = spark.read.parquet(f"{path}/blocks").mapInArrow(lean(run), ddl)
    parts = spark.read.parquet(f"{path}/parts")      # one row per part: a small side by size
    cols = ["doc_id", (F.col("start") + F.col("local_start")).alias("start"),
            "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return docs.join(parts, "part").select(*cols)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, kind: str = "words") -> DataFrame:
    """:func:`write` to a fresh shared folder, then :func:`read`."""
    path = fresh_dir(docs.sparkSession, "rans")
    write(docs, path, tokenizer, end_id, kind)
    return read(docs.sparkSession, path)
