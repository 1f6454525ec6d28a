"""Nearest neighbours by a hash-prefix forest.

Every tree hashes a vector to a long string: ``DEPTH`` symbols, each the nearest of the
2*dim signed axes after a random rotation (a cross-polytope hash).  A tree is the sorted
array of its strings, so the rows that share a prefix with a query are one run of it.

The trees ascend together: the common level of a query is the deepest prefix length at
which its runs in all trees hold enough rows in sum: the entries over ``SHARE``, at least
``LEAST_CANDIDATES`` (else length 0, where one tree holds every row).  Every row of these runs
is a candidate, however long the runs are; candidates are ranked by exact cosine in double
precision.  The number grows with the table because spread vectors need it: a fixed one loses
recall as rows are added.  ``candidates`` sets another.

Spark sorts: (tree, string, id) is range partitioned and written, which fixes a global
rank; the same tasks note the runs that hold a query.  Ranks are cut to buckets of
``BUCKET`` rows or less, and a query is sent to every bucket that its run touches, so the
rows a task holds are bounded whatever the vectors are.  The work is the rows in the runs:
for spread vectors a share of the table per query, and m rows of one hash string cost m
times their queries, as nothing but the exact scan tells them apart.  Equal vectors are one entry with its
smallest ids (at most ``k + 1``: more can never be returned).

Defined results: vectors that are null, zero, or hold null or non-finite components take
no part, as query or candidate; a null id takes no part; vectors of another length are
never compared; rows with equal id and vector count once; an id with several vectors is as many
rows, each a query and a candidate of its own (also of the others); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import lean, require_columns, written
from martlight.operators.ranking import global_row_number

TREES = 48
DEPTH = 6                 # symbols of a hash string
WINDOW = 1_024            # rows of a run that are scored at a time: bounds memory, not what is visited
SHARE = 4                 # the ascent ends where the trees' runs hold a row in so many, in sum ...
LEAST_CANDIDATES = 512    # ... or this many, if that is more
BUCKET = 4_096            # most rows of a bucket
LEAST_BUCKET = 256        # rows of a bucket of a small table
SEED = 5
_HEAD = 6                 # bytes before the symbols: vector length and tree


def rotation(dim: int, tree: int, symbol: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, dim, tree, symbol])
    q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def symbols(v: np.ndarray, r: np.ndarray) -> np.ndarray:
    """One symbol per row: 2 * axis + (the largest component is positive)."""
    y = v @ r
    axis = np.abs(y).argmax(1)
    return 2 * axis + (y[np.arange(len(v)), axis] > 0)


def _by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        part = column.take(pa.array(at))
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(dim)).astype(np.float64)


def _hash_task(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple, np.ndarray] = {}
        for b in batches:
            ids, query = b.column("vid").to_numpy(), b.column("is_query").to_numpy(zero_copy_only=False)
            for at, x in _by_length(b.column("vector")):
                dim = x.shape[1]
                for t in range(trees):
                    s = np.empty((len(x), depth), dtype=">u2")
                    for j in range(depth):
                        if (dim, t, j) not in made:
                            made[dim, t, j] = rotation(dim, t, j)
                        s[:, j] = symbols(x, made[dim, t, j])
                    head = dim.to_bytes(4, "big") + t.to_bytes(2, "big")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([head + r.tobytes() for r in s], pa.binary()), pa.array(ids[at]),
                         pa.array(query[at])], ["key", "vid", "is_query"])
    return run


def _number(depth: int):
    """Adds the partition and the row's place in it.  Rows without ``vid`` are added for the
    runs of equal prefixes: prefix, first place and length ``n`` of those that hold a query or
    may go on in another partition."""
    names = ["key", "vid", "is_query", "part", "at", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}          # level: prefix, first place, rows, queries, at the start

        def runs(found: list) -> pa.RecordBatch:
            m = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
                 pa.array([part] * m, pa.int32()), pa.array([int(f[1]) for f in found], pa.int64()),
                 pa.array([int(f[2]) for f in found], pa.int64())], names)

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)),
                 pa.nulls(n, pa.int64())], names)
            raw = np.frombuffer(b"".join(b.column("key").to_pylist()), np.uint8).reshape(n, -1)
            alike = np.cumprod(raw[1:] == raw[:-1], axis=1).sum(1)      # leading bytes as in the row before
            asked = np.concatenate([[0], np.cumsum(b.column("is_query").to_numpy(zero_copy_only=False))])
            found: list = []
            for lv in range(depth + 1):
                w = _HEAD + 2 * lv
                cuts = np.concatenate([[0], np.flatnonzero(alike < w) + 1, [n]])
                o = held.get(lv)
                if o and o[0] != raw[0, :w].tobytes():
                    if o[3] or o[4]:
                        found.append(o)
                    o = None
                o = o or [raw[0, :w].tobytes(), at, 0, 0, at == 0]
                o[2] += cuts[1]
                o[3] += asked[cuts[1]]
                if len(cuts) > 2:
                    if o[3] or o[4]:
                        found.append(o)
                    for i in np.flatnonzero(asked[cuts[2:-1]] > asked[cuts[1:-2]]) + 1:
                        found.append((raw[cuts[i], :w].tobytes(), at + cuts[i], cuts[i + 1] - cuts[i]))
                    o = [raw[cuts[-2], :w].tobytes(), at + cuts[-2], n - cuts[-2], asked[n] - asked[cuts[-2]], False]
                held[lv] = o
            if found:
                yield runs(found)
            at += n
        if held:
            yield runs(list(held.values()))
    return run


def index(vectors: DataFrame, trees: int = TREES, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """The sorted arrays of all trees, one after another (key, vid, is_query, rank), and the
    runs of equal prefixes that hold a query (prefix, lo, n: first rank and length), from
    written tables.  ``vectors``: vid, vector, is_query."""
    spark = vectors.sparkSession
    rows = written(vectors.mapInArrow(lean(_hash_task(trees, depth)), "key binary, vid long, is_query boolean"),
                   "ann-hashes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = written(rows.repartitionByRange(n, "key", "vid").sortWithinPartitions("key", "vid")
                   .mapInArrow(lean(_number(depth)),
                               "key binary, vid long, is_query boolean, part int, at long, n long"), "ann-sorted")
    sorted_rows = both.where("vid is not null")
    counts = sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))     # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    rank = (F.col("start") + F.col("at")).alias("rank")
    runs = written(both.where("vid is null").join(starts, "part").select("key", rank, "n")
                   .groupBy(F.col("key").alias("prefix")).agg(F.min("rank").alias("lo"), F.sum("n").alias("n")),
                   "ann-runs")
    return sorted_rows.join(starts, "part").select("key", "vid", "is_query", rank), runs


def _search_task(k: int, window: int):
    """The nearest k+1 of the bucket's rows for each query sent to it, among the rows from
    place ``a`` to ``z``.  A bucket's rows come first, by place, then its queries."""
    most = max(1, (1 << 18) // window)        # queries scored at a time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, asked in _groups(batches):
            vid, flat, offset = rows
            a, z = asked.column("a").to_numpy(), asked.column("z").to_numpy()
            qid = asked.column("vid").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(a) != 0) | (np.diff(z) != 0)) + 1).tolist(), len(a)]
            for i, j in zip(cuts, cuts[1:]):
                lo, hi = int(a[i]), int(z[i])
                x = flat[offset[lo]:offset[hi]].reshape(hi - lo, -1)
                by_id = np.argsort(vid[lo:hi])
                for first in range(i, j, most):
                    ids = qid[first:min(j, first + most)]
                    q = asked.column("vector").slice(first, len(ids)).flatten().to_numpy().reshape(len(ids), -1)
                    own = by_id[np.minimum(np.searchsorted(vid[lo:hi], ids, sorter=by_id), hi - lo - 1)]
                    own[vid[lo:hi][own] != ids] = -1
                    at, near, score = _top(x, vid[lo:hi], q, own, k, window)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(vid[lo:hi][near]), pa.array(score)], ["qid", "vid", "score"])
    return run


def _top(x: np.ndarray, vid: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, window: int):
    """Query, row and cosine of the nearest k+1 rows of ``x`` to each query but ``own``, ties
    to the smaller ``vid``."""
    norm, qnorm = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
    ats, nears, scores = [], [], []
    step = max(1, (1 << 22) // x.shape[1])
    for lo in range(0, len(x), window):
        part = x[lo:lo + window]
        about = (q @ part.T) / (qnorm[:, None] * norm[lo:lo + window])
        mine = np.flatnonzero((own >= lo) & (own < lo + len(part)))
        about[mine, own[mine] - lo] = -np.inf
        least = np.full(len(q), -np.inf)
        if len(part) > k + 1:           # all that may tie with the (k+1)-th
            least = np.partition(about, -k - 1, axis=1)[:, -k - 1] - 1e-9
        at, near = np.nonzero((about >= least[:, None]) & (about > -np.inf))
        for i in range(0, len(at), step):
            f, g = at[i:i + step], near[i:i + step] + lo
            # summed row by row: the same pair gets the same score in every tree
            ats.append(f)
            nears.append(g)
            scores.append((x[g] * q[f]).sum(1) / (norm[g] * qnorm[f]))
    if not ats:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at, near, score = np.concatenate(ats), np.concatenate(nears), np.concatenate(scores)
    order = np.lexsort((vid[near], -score, at))
    at, near, score = at[order], near[order], score[order]
    nth = np.arange(len(at)) - np.searchsorted(at, at)
    return at[nth <= k], near[nth <= k], score[nth <= k]


def _groups(batches: Iterator[pa.RecordBatch]):
    """A bucket's rows (ids, components, offsets) with each batch of its queries."""
    now, held, rows = None, [], None
    for b in batches:
        bucket, query = b.column("bucket").to_numpy(), b.column("query").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((np.diff(bucket) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1).tolist(),
                len(bucket)]
        for i, j in zip(cuts, cuts[1:]):
            if j == i:
                continue
            if bucket[i] != now:
                now, held, rows = bucket[i], [], None
            if not query[i]:
                held.append(b.slice(i, j - i))
                continue
            if rows is None:
                t = pa.Table.from_batches(held)
                vectors = t.column("vector").combine_chunks()
                rows = (t.column("vid").to_numpy(), vectors.flatten().to_numpy(),
                        np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy())]))
            yield rows, b.slice(i, j - i)


def valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector (array<double>) of the rows that take part."""
    require_columns(rows, [id_col, vector_col], "vectors")
    v = F.col("vector")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
            .where("id is not null and vector is not null").where(finite)
            .where(F.exists(v, lambda x: x != 0)))


def nearest(rows: DataFrame, id_col: str, vector_col: str, is_query, k: int = 5, trees: int = TREES,
            window: int = WINDOW, candidates: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score: for every row for which ``is_query`` (a column of ``id``)
    holds, its k nearest others, nearest first, ties to the smaller id."""
    rows = written(valid(rows, id_col, vector_col).distinct()
                   .withColumn("h", F.xxhash64("vector")).withColumn("asks", is_query(F.col("id"))), "ann-rows")
    # equal vectors: the k+1 smallest ids, first per salt, then per vector
    salt = F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")
    few = (rows.select("vector", "h", "id", "asks", salt)
           .withColumn("i", F.row_number().over(Window.partitionBy("h", "vector", "salt").orderBy("id"))))
    asks = rows.groupBy("h", "vector").agg(F.max("asks").alias("is_query"))
    members = (few.where(F.col("i") <= k + 1)
               .groupBy("h", "vector").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids")))
    # an entry's number goes by its smallest id, so ties of entries are ties of ids
    entry = written(global_row_number(
        members.join(asks, ["h", "vector"]).select(F.element_at("ids", 1).alias("least"), "h", "vector", "ids", "is_query"),
        ["least", "h"], name="vid").select("vid", "h", "vector", "ids", "is_query"), "ann-entries")
    ranked, runs = index(entry.select("vid", "vector", "is_query"), trees)
    # a query's runs in every tree, by level; all trees hold the same rows at level 0
    levels = F.when(F.substring("key", 5, 2) == F.lit(bytes(2)), F.sequence(F.lit(0), F.lit(DEPTH))).otherwise(
        F.sequence(F.lit(1), F.lit(DEPTH)))
    places = written(ranked.where("is_query").select(F.col("vid").alias("qid"), "key", F.explode(levels).alias("level"))
                     .withColumn("prefix", F.expr(f"substring(key, 1, {_HEAD} + 2 * level)"))
                     .join(runs, "prefix").select("qid", "level", "lo", "n"), "ann-places")
    # synchronous ascent: the deepest level at which the trees hold enough rows
    n = entry.count()
    if candidates is None:
        candidates = max(LEAST_CANDIDATES, n // SHARE)
    stop = (places.groupBy("qid", "level").agg(F.sum(F.col("n") - 1).alias("seen"))
            .groupBy("qid").agg(F.coalesce(F.max(F.when(F.col("seen") >= candidates, F.col("level"))),
                                           F.lit(0)).alias("stop")))
    # every bucket that a run of the stop level touches
    size = max(1, min(bucket, max(LEAST_BUCKET, n // 32)))
    visits = written(places.join(stop, "qid").where("level = stop")
                     .select("qid", "lo", "n", F.expr(f"explode(sequence(lo div {size}L, (lo + n - 1) div {size}L))")
                             .alias("bucket"))
                     .select("bucket", F.col("qid").alias("vid"),
                             F.expr(f"greatest(lo - bucket * {size}L, 0L)").alias("a"),
                             F.expr(f"least(lo + n - bucket * {size}L, {size}L)").alias("z")), "ann-visits")
    dealt = (ranked.select(F.expr(f"rank div {size}L").alias("bucket"), F.lit(False).alias("query"),
                           F.expr(f"rank % {size}L").alias("a"), F.lit(0).cast("long").alias("z"), "vid")
             .union(visits.select("bucket", F.lit(True), "a", "z", "vid"))
             .join(entry.select("vid", "vector"), "vid")
             .select("bucket", "query", "a", "z", "vid", "vector"))
    found = written(dealt.repartition("bucket").sortWithinPartitions("bucket", "query", "a", "z")
                    .mapInArrow(lean(_search_task(k, window)), "qid long, vid long, score double"), "ann-found")
    best = found.groupBy("qid", "vid").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vid")
    best = best.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1).drop("i")
    # the query's own vector stands for its copies; then every entry's smallest ids
    own_copies = entry.where("is_query").select(F.col("vid").alias("qid"), F.col("vid"), F.lit(1.0).alias("score"))
    named = (best.union(own_copies).join(entry.select("vid", "ids", "vector"), "vid")
             .withColumn("score", F.when(F.col("qid") == F.col("vid"), _self_cosine(F.col("vector")))
                         .otherwise(F.col("score")))
             .select("qid", "score", "vid", F.explode("ids").alias("vec_id"))
             .withColumn("i", F.row_number().over(
                 Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id", "vid")))
             .where(F.col("i") <= k + 1)
             .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "vid")))
                                 .alias("near")))
    listed = written(entry.where("is_query").select("h", "vector", F.col("vid").alias("qid"))
                     .join(named, "qid").select("h", "vector", "qid", "near"), "ann-lists")
    # all but the query's own row
    others = F.slice(F.filter("near", lambda x: (x["vec_id"] != F.col("query_id")) | (x["vid"] != F.col("qid"))), 1, k)
    return (rows.where("asks").select(F.col("id").alias("query_id"), "h", "vector")
            .join(listed, ["h", "vector"])
            .select("query_id", F.posexplode(others).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    (-F.col("x.s")).alias("score")))


def _self_cosine(v):
    """The cosine of a vector with itself, as the sum of squares over its root squared."""
    s = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    return s / (F.sqrt(s) * F.sqrt(s))
