"""Spelling variants by a trie of letter-count vectors.

Letters are dealt to ``GROUPS`` groups; a word's vector is its length and how many letters of
each group it has, packed into one long.  The vectors form a trie: level 0 is the length, every
further level the count of one more group.  Words one edit apart have vectors that differ by
at most one surplus and one deficit, so a search descends depth first and spends a budget
of one each: a word looks for words of its own length, surplus before deficit (the other
order is found from the other word), and for words one letter longer, with a surplus only.
What stands at the leaves reached is verified letter by letter.

Spark holds the top of the trie.  Level by level, a node of more than ``NODE_WORDS`` words
goes on to its children, and so do the searches, which are joined to the nodes that exist;
smaller nodes are searched within one task.  A node that stays large down to the last level
(words of equal vectors) is dealt to blocks, and its searches go to every block.  Counts and
links are grouped with partial aggregates, so no frequent word or form is a single task.

Words and counts are those of the whole table.  A word's form is its near word of largest
count if that is ``RATIO`` times its own; forms are followed to the last by doubling steps.

Defined results: a null or empty text has no words; a null ``doc_id`` is no number, so no
letter is left out of its words; repeated rows count each; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import lean, pick, text_or_empty, written

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10                # least count of a form, in counts of its word
GROUPS = 18               # 17 of the plain letters, one of the others
BITS = 3                  # of a group's count; larger counts are taken for one
NODE_WORDS = 32_768       # most words of a trie node that one task searches
FLUSH = 200_000           # distinct words a counting task holds at a time
SLICE = 4_096             # searches that descend together

_TOP = BITS * GROUPS      # bits below the length
_MOST_LENGTH, _MOST = 31, (1 << BITS) - 1
_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")

# what a search may still spend
DONE, DEFICIT, EITHER, SURPLUS = 0, 1, 2, 3


# --- words ------------------------------------------------------------------------

def drop_letter(doc_id: int | None) -> Callable[[str], str]:
    """Leaves one letter out of every 31st run of a document, by the crc32 of ``id:run``."""
    if doc_id is None:
        return lambda run: run
    start = zlib.crc32(f"{doc_id}:".encode())

    def drop(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % 31:
            return run
        i = h % len(run)
        return run[:i] + run[i + 1:]
    return drop


def as_written(doc_id: int | None) -> Callable[[str], str]:
    """Runs as they stand in the text."""
    return lambda run: run


def _count_task(edit_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        counts: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                edit = edit_of(doc)
                low = text.as_py().encode().lower().decode()        # A-Z only
                for w, n in Counter(_RUN.findall(low)).items():
                    w = edit(w)
                    if len(w) >= MIN_LETTERS:
                        counts[w] += n
                if len(counts) > FLUSH:
                    yield flush()
        if counts:
            yield flush()
    return run


def _group_of() -> np.ndarray:
    """The group of every Latin-1 letter."""
    code = np.arange(256)
    return np.where(code < 128, (code - 97) % (GROUPS - 1), GROUPS - 1)


def vectors(words: list[str]) -> np.ndarray:
    """The packed length and letter counts of each word."""
    raw = "".join(words).encode("latin-1")
    sizes = np.array([len(w) for w in words], np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    group = _group_of()[np.frombuffer(raw, np.uint8)]
    counts = np.bincount(of * GROUPS + group, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    out = np.minimum(sizes, _MOST_LENGTH)
    for g in range(GROUPS):
        out = out << BITS | np.minimum(counts[:, g], _MOST)
    return out


def _vector_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors(b.column("word").to_pylist()))],
                                             ["word", "n", "key"])


def vocabulary(docs: DataFrame, edit_of=as_written) -> DataFrame:
    """word, n, key (the packed vector) of every word that counts, from a written table."""
    rows = pick(docs, ["doc_id", "text"], "docs").where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts = (rows.mapInArrow(lean(_count_task(edit_of)), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))
    return written(counts.mapInArrow(lean(_vector_task), "word string, n long, key long"), "spelling-words")


# --- the top of the trie ------------------------------------------------------------

def _asked(length) -> F.Column:
    """The nodes of level 0 that a word looks in, with what it may spend there."""
    own = F.struct(length.alias("node"), F.lit(EITHER).alias("left"))
    longer = F.struct((length + 1).alias("node"), F.lit(SURPLUS).alias("left"))
    return F.when(length < _MOST_LENGTH, F.array(own, longer)).otherwise(F.array(own))


def _children(shift: int) -> F.Column:
    """The children of a node that a search (or a word of its own, which spends nothing) goes
    on to, with what it may spend there.  What it has spent so far is in ``node`` alone."""
    node, left = F.shiftleft("node", BITS), F.col("left")
    own = F.shiftright("key", shift).bitwiseAND(_MOST)

    def child(count, what):
        return F.struct((node + count).alias("node"), what.cast("int").alias("left"))

    more = F.when(F.col("query") & left.isin(EITHER, SURPLUS) & (own < _MOST),
                  child(own + 1, F.when(left == EITHER, DEFICIT).otherwise(DONE)))
    less = F.when(F.col("query") & (left == DEFICIT) & (own > 0), child(own - 1, F.lit(DONE)))
    return F.filter(F.array(child(own, left), more, less), lambda x: x.isNotNull())


def dealt(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """Every word under the node that one task searches (query false), and every search under
    each such node it reaches: level, node, block, query, left, key, n, word."""
    cols = ["query", "left", "key", "n", "word"]
    length = F.shiftright("key", _TOP)
    rows = (words.select(F.lit(False).alias("query"), F.lit(DONE).alias("left"), "key", "n", "word",
                         length.alias("node"))
            .union(words.select(F.explode(_asked(length)).alias("x"), "key", "n", "word")
                   .select(F.lit(True), "x.left", "key", "n", "word", "x.node")))
    out = None
    for level in range(GROUPS + 1):
        shift = _TOP - BITS * level
        nodes = (rows.where("not query").groupBy("node").agg(F.count(F.lit(1)).alias("words"))
                 .withColumn("blocks", F.ceil(F.col("words") / node_words).cast("int")))
        rows = written(rows.join(nodes, "node").select("node", "blocks", *cols), f"spelling-level{level}")
        last = level == GROUPS
        here = rows if last else rows.where("blocks = 1")
        # copies only where equal vectors fill more than one block
        block = F.when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))
        here = here.select(F.lit(level).alias("level"), "node", F.explode(block).alias("block"), *cols)
        out = here if out is None else out.union(here)
        if last or rows.where("blocks > 1").isEmpty():
            return out
        rows = (rows.where("blocks > 1").withColumn("x", F.explode(_children(shift - BITS)))
                .select("query", "x.left", "key", "n", "word", "x.node"))
    raise AssertionError("the last level returns")


# --- the search in a node -------------------------------------------------------------

def one_edit(a: str, b: str) -> bool:
    """Exactly one letter replaced, left out or added."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _letters(words: list[str], width: int) -> np.ndarray:
    """The words' letters, one row each, filled up with zeros."""
    raw = b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words)
    return np.frombuffer(raw, np.uint8).reshape(len(words), width)


def descend(keys: np.ndarray, key: np.ndarray, target: np.ndarray, left: np.ndarray,
            level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(search, vector reached) pairs, depth first: ``keys`` are the vectors of a node in
    order, ``key`` the searches' own, ``target`` theirs with what they spent above."""
    todo = [(level, np.arange(len(key)), target, left)]
    while todo:
        level, who, to, spend = todo.pop()
        if level == GROUPS:
            yield who, np.searchsorted(keys, to)
            continue
        shift = _TOP - BITS * (level + 1)
        own = key[who] >> shift & _MOST
        more = np.flatnonzero((spend >= EITHER) & (own < _MOST))
        less = np.flatnonzero((spend == DEFICIT) & (own > 0))
        whos = np.concatenate([who, who[more], who[less]])
        tos = np.concatenate([to, to[more] + (1 << shift), to[less] - (1 << shift)])
        spends = np.concatenate([spend, np.where(spend[more] == EITHER, DEFICIT, DONE), np.full(len(less), DONE)])
        low = tos >> shift << shift
        at = np.searchsorted(keys, low)
        there = keys[np.minimum(at, len(keys) - 1)]
        live = (at < len(keys)) & (there < low + (1 << shift))
        todo.append((level + 1, whos[live], tos[live], spends[live]))


def _near(node: dict, level: int, prefix: int, asks: dict) -> tuple[np.ndarray, np.ndarray]:
    """(search, word) pairs of a node that are one edit apart; each pair of words once."""
    keys, first, size = node["keys"], node["first"], node["size"]
    shift = _TOP - BITS * level
    key = asks["key"]
    target = prefix << shift | key & ((1 << shift) - 1)
    found_a, found_b = [], []
    for who, at in descend(keys, key, target, asks["left"], level):
        many = size[at]
        a = np.repeat(who, many)
        b = np.repeat(first[at] - np.cumsum(many) + many, many) + np.arange(len(a))
        # of two words with one vector the lesser asks
        twin = np.flatnonzero(key[a] == keys[np.repeat(at, many)])
        if len(twin):
            drop = [asks["word"][i] >= node["word"][j] for i, j in zip(a[twin].tolist(), b[twin].tolist())]
            keep = np.ones(len(a), bool)
            keep[twin[np.array(drop)]] = False
            a, b = a[keep], b[keep]
        for i in range(0, len(a), 1 << 18):
            x, y = a[i:i + (1 << 18)], b[i:i + (1 << 18)]
            ok = _verified(node, asks, x, y)
            found_a.append(x[ok])
            found_b.append(y[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a) if found_a else none), (np.concatenate(found_b) if found_b else none)


def _verified(node: dict, asks: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart."""
    la, lb = asks["length"][a], node["length"][b]
    ok = np.zeros(len(a), bool)
    width = node["letters"].shape[1] - 1
    short = (la < _MOST_LENGTH) & (lb < _MOST_LENGTH)
    same = np.flatnonzero(short & (la == lb))
    ok[same] = (asks["letters"][a[same]] != node["letters"][b[same], :width]).sum(1) == 1
    plus = np.flatnonzero(short & (la + 1 == lb))
    if len(plus):
        x, y = asks["letters"][a[plus]], node["letters"][b[plus]]
        head = np.logical_and.accumulate(x == y[:, :width], axis=1).sum(1)
        inside = np.arange(width) < la[plus][:, None]
        tail = np.logical_and.accumulate(((x == y[:, 1:]) | ~inside)[:, ::-1], axis=1).sum(1) - (width - la[plus])
        ok[plus] = np.minimum(head, la[plus]) + tail >= la[plus]
    for i in np.flatnonzero(~short).tolist():
        ok[i] = one_edit(asks["word"][a[i]], node["word"][b[i]])
    return ok


def _search_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by node and block, words before searches."""
    names = ["a", "n_a", "b", "n_b"]
    now, held, node = None, [], None

    def built(parts: list[pa.RecordBatch], width: int) -> dict:
        t = pa.Table.from_batches(parts)
        key = t.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        word = t.column("word").take(pa.array(order)).to_pylist()
        keys, first, size = np.unique(key[order], return_index=True, return_counts=True)
        return {"keys": keys, "first": first, "size": size, "word": word, "n": t.column("n").to_numpy()[order],
                "length": np.array([len(w) for w in word]), "letters": _letters([w[:width] for w in word], width)}

    for b in batches:
        if not b.num_rows:
            continue
        spot = [b.column(c).to_numpy(zero_copy_only=False) for c in ("level", "node", "block", "query")]
        new = np.zeros(b.num_rows, bool)
        for c in spot:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            here = tuple(int(c[i]) for c in spot[:3])
            if here != now:
                now, held, node = here, [], None
            if not spot[3][i]:
                held.append(b.slice(i, j - i))
                continue
            if not held:
                continue                        # a search in a block without words
            if node is None:
                node = built(held, _MOST_LENGTH)
            for at in range(i, j, SLICE):
                part = b.slice(at, min(SLICE, j - at))
                word = part.column("word").to_pylist()
                asks = {"word": word, "key": part.column("key").to_numpy(), "left": part.column("left").to_numpy(),
                        "n": part.column("n").to_numpy(), "length": np.array([len(w) for w in word]),
                        "letters": _letters([w[:_MOST_LENGTH - 1] for w in word], _MOST_LENGTH - 1)}
                x, y = _near(node, here[0], here[1], asks)
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([word[k] for k in x.tolist()], pa.string()), pa.array(asks["n"][x]),
                         pa.array([node["word"][k] for k in y.tolist()], pa.string()), pa.array(node["n"][y])], names)


def near_pairs(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """a, n_a, b, n_b: every pair of words one edit apart, once."""
    spot = ["level", "node", "block"]
    return (dealt(words, node_words).repartition(*spot).sortWithinPartitions(*spot, "query")
            .mapInArrow(lean(_search_task), "a string, n_a long, b string, n_b long"))


# --- forms and roots --------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word of ``forms`` (word, form): the last of the forms that follow."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # twice as many steps; a form of many words is split by adaptive execution
        step = written(now.join(then, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, edit_of=as_written, node_words: int = NODE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    words = vocabulary(docs, edit_of)
    pairs = written(near_pairs(words, node_words), "spelling-pairs")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a"))
    # the largest count, then the least word
    near = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("s"), F.col("b").alias("w"))).alias("top"))
    is_form = -F.col("top.s") >= RATIO * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("top.w")).alias("form"), F.when(is_form, -F.col("top.s")).alias("form_n")),
        "spelling-forms")
    last = roots(found.where("form is not null").select("word", "form"))
    return (found.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
