"""Best-fit packing of documents into fixed-length sequences by a grouping genetic
algorithm on distributed islands.

Documents are tokenized, ended with the end id and, if longer than a sequence, cut
into pieces, the first of which takes the remainder.  Full pieces are sequences by
themselves; the others are dealt by hash to blocks of about ``BLOCK`` pieces.  On every
block ``ISLANDS`` populations evolve in separate tasks:

* a chromosome is a set of bins; the first comes from best-fit decreasing, the rest
  from best-fit over perturbed orders;
* crossover injects whole well-filled bins of one parent into another, removes the
  bins that would hold a piece twice, and best-fits the displaced pieces;
* mutation dissolves the emptiest bins;
* evolution ends at the block's lower bound (then nothing better exists) or after
  ``GENERATIONS``.

After an epoch each island's elite migrates to the next island of its block, and the
islands evolve again.  The poorly filled bins of all blocks are then dissolved and their
pieces packed once more together, so blocks cost no bins.

Blocks are bounded, whatever key a third of the rows share; every epoch is written, so
a lost executor repeats one epoch of its blocks.

Defined results: a null text is empty (one piece, the end id); repeated rows are
documents of their own; a null ``doc_id`` is kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lean, pick, text_or_empty, written
from martlight.llm.tokens import crc_u32, open_tokenizer

CAPACITY = 1024
BLOCK = 8_192             # pieces of a block
ISLANDS = 2               # populations per block
EPOCHS = 2                # an elite migrates between epochs
POPULATION = 4
GENERATIONS = 6           # per epoch
WELL_FILLED = 0.97        # bins below are packed once more across blocks
SEED = 11


# --- pieces ---------------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
           kind: str = "gpt") -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32; ``uid`` numbers the pieces of a task and
    is only stable once written."""
    ddl = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 36
        tok = open_tokenizer(tokenizer, kind)
        end = np.array([end_id], dtype=tok.dtype).tobytes()
        for b in batches:
            rows = []
            for doc, raw in zip(b.column("doc_id").to_pylist(),
                                tok.batches(b.column("text").to_pylist())):
                ids = np.frombuffer(raw + end, dtype=tok.dtype)
                n = len(ids)
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for i, (a, z) in enumerate(zip(edges, edges[1:])):
                    rows.append((uid, doc, i, a, z - a, crc_u32(ids[a:z])))
                    uid += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return (pick(docs, ["doc_id", "text"], "docs")
            .select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(lean(run, "tokens"), ddl))


# --- the genetic algorithm on one block -------------------------------------------

def lower_bound(length: np.ndarray, capacity: int) -> int:
    """Martello and Toth's L2: pieces above half need bins of their own, and the rest fills
    what these leave."""
    count = np.bincount(length, minlength=capacity + 1)
    total = np.cumsum(count * np.arange(capacity + 1))
    number = np.cumsum(count)
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    for k in range(half + 1):
        big = int(number[-1] - number[capacity - k])
        mid = int(number[capacity - k] - number[half])
        mid_sum = int(total[capacity - k] - total[half])
        small = int(total[half] - (total[k - 1] if k else 0))
        best = max(best, big + mid + max(0, -(-(small - (mid * capacity - mid_sum)) // capacity)))
    return best


def best_fit(order, length: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Put every piece of ``order`` into the fullest of ``bins`` (changed in place) it fits,
    else into a new one."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0                          # bit r: some bin has r left
    for i, b in enumerate(bins):
        left = capacity - sum(length[x] for x in b)
        if left:
            room[left].append(i)
            open_rooms |= 1 << left
    for x in order:
        size = length[x]
        fits = open_rooms >> size
        if fits:
            r = (fits & -fits).bit_length() - 1 + size
            i = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
            bins[i].append(x)
            left = r - size
        else:
            i = len(bins)
            bins.append([x])
            left = capacity - size
        if left:
            room[left].append(i)
            open_rooms |= 1 << left
    return bins


def fitness(bins: list[list[int]], length: list[int], capacity: int) -> float:
    """Mean squared fill: rewards full bins over evenly filled ones."""
    return sum((sum(length[x] for x in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _rank(bins, length, capacity) -> tuple:
    return len(bins), -fitness(bins, length, capacity)


def crossover(into: list[list[int]], giver: list[list[int]], length: list[int], capacity: int,
              rng: np.random.Generator) -> list[list[int]]:
    """``into`` with a random part of the giver's best-filled bins injected whole."""
    fill = [sum(length[x] for x in b) for b in giver]
    best = sorted(range(len(giver)), key=lambda i: -fill[i])[:max(1, len(giver) // 2)]
    gift = [giver[i] for i in best if rng.random() < 0.5]
    held = {x for b in gift for x in b}
    kept, displaced = [], []
    for b in into:
        if held.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [x for x in b if x not in held]
    displaced.sort(key=lambda x: -length[x])
    return best_fit(displaced, length, [list(b) for b in gift] + kept, capacity)


def mutate(bins: list[list[int]], length: list[int], capacity: int,
           rng: np.random.Generator) -> list[list[int]]:
    """Dissolve the emptiest bins and a few others; best-fit their pieces anew."""
    order = sorted(range(len(bins)), key=lambda i: sum(length[x] for x in bins[i]))
    n = max(2, len(bins) // 20)
    gone = set(order[:n]) | set(rng.choice(len(bins), size=min(len(bins), n), replace=False).tolist())
    loose = [x for i in gone for x in bins[i]]
    loose.sort(key=lambda x: -length[x])
    return best_fit(loose, length, [list(b) for i, b in enumerate(bins) if i not in gone], capacity)


def evolve(length: list[int], capacity: int, seed: int, elite: list[list[list[int]]] = (),
           generations: int = GENERATIONS, population: int = POPULATION) -> list[list[int]]:
    """The best chromosome found for one block; ``elite`` are chromosomes to start from."""
    sizes = np.array(length, dtype=np.int64)
    least = lower_bound(sizes, capacity)
    rng = np.random.default_rng(seed)
    people = [list(map(list, e)) for e in elite]
    if not people:
        people = [best_fit(np.argsort(-sizes, kind="stable").tolist(), length, [], capacity)]
    if min(map(len, people)) > least:
        while len(people) < population:
            jitter = sizes * rng.uniform(0.9, 1.1, len(sizes))
            people.append(best_fit(np.argsort(-jitter, kind="stable").tolist(), length, [], capacity))
        people.sort(key=lambda p: _rank(p, length, capacity))
        for _ in range(generations):
            if len(people[0]) <= least:
                break
            a, b = rng.choice(len(people), size=2, replace=False)
            child = crossover(people[a], people[b], length, capacity, rng)
            people += [child, mutate(people[0], length, capacity, rng)]
            people = sorted(people, key=lambda p: _rank(p, length, capacity))[:population]
    return min(people, key=lambda p: _rank(p, length, capacity))


# --- blocks and islands -----------------------------------------------------------

def _bins_of(label: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for x, b in enumerate(label):
        bins.setdefault(b, []).append(x)
    return list(bins.values())


_STATE = "block long, island int, uids array<long>, lengths array<int>, bins array<int>, n_bins int, fit double"


def _island_task(capacity: int, epoch: int):
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
             pa.int32(), pa.float64()]
    names = ["block", "island", "uids", "lengths", "bins", "n_bins", "fit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                length = r["lengths"]
                elite = [_bins_of(e) for e in r["elite"] or []]
                seed = [SEED, epoch, r["block"], r["island"]]
                best = evolve(length, capacity, int(np.random.SeedSequence(seed).generate_state(1)[0]), elite)
                label = [0] * len(length)
                for i, b in enumerate(best):
                    for x in b:
                        label[x] = i
                row = (r["block"], r["island"], r["uids"], length, label, len(best),
                       fitness(best, length, capacity))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
    return run


def pack_blocks(items: DataFrame, capacity: int, name: str) -> DataFrame:
    """uid, block, bin, length, fill (of the bin), offset for every row of ``items``
    (uid, length), packed block by block."""
    n = items.count()
    blocks = max(1, -(-n // BLOCK))
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block")
    # a block is about BLOCK rows by construction: a bounded list
    state = (items.select(block, F.struct("uid", F.col("length").cast("int").alias("length")).alias("x"))
             .groupBy("block").agg(F.array_sort(F.collect_list("x")).alias("x"))
             .select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                     F.col("x.uid").alias("uids"), F.col("x.length").alias("lengths"),
                     F.lit(None).cast("array<array<int>>").alias("elite")))
    for epoch in range(EPOCHS):
        done = written(state.repartition("block", "island")
                       .mapInArrow(lean(_island_task(capacity, epoch)), _STATE), f"pack-{name}-{epoch}")
        if epoch + 1 < EPOCHS:
            sent = done.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                               F.col("bins").alias("migrant"))
            state = (done.join(sent, ["block", "island"])
                     .select("block", "island", "uids", "lengths", F.array("bins", "migrant").alias("elite")))
    best = done.groupBy("block").agg(F.min(F.struct("n_bins", -F.col("fit"), "island")).alias("b"))
    chosen = done.join(best, "block").where(F.col("island") == F.col("b.island"))

    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    names = ["uid", "block", "bin", "length", "fill", "offset"]

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fill = [0] * r["n_bins"]
                at = []
                for b, size in zip(r["bins"], r["lengths"]):
                    at.append(fill[b])
                    fill[b] += size
                cols = [r["uids"], [r["block"]] * len(at), r["bins"], r["lengths"],
                        [fill[b] for b in r["bins"]], at]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return chosen.select("block", "uids", "lengths", "bins", "n_bins").mapInArrow(
        lean(lay_out), "uid long, block long, bin int, length int, fill int, offset int")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
         kind: str = "gpt") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = written(pieces(docs, tokenizer, end_id, capacity, kind), "pack-pieces")
    small = cut.where(F.col("length") < capacity).select("uid", "length")
    first = written(pack_blocks(small, capacity, "first"), "pack-first")
    good = F.col("fill") >= int(WELL_FILLED * capacity)
    second = written(pack_blocks(first.where(~good).select("uid", "length"), capacity, "second"),
                     "pack-second")
    number = (F.shiftleft(F.col("block"), 25) + F.col("bin").cast("long") * 2)
    placed = (first.where(good).select("uid", number.alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
              .union(second.select("uid", (number + 1).alias("sequence_id"), F.col("offset").cast("long"))))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = cut.where(F.col("length") == capacity).select(
        *cols, (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return cut.where(F.col("length") < capacity).join(placed, "uid").select(
        *cols, "sequence_id", "offset").union(whole)
