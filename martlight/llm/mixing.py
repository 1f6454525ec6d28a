"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all words, stopped at ``max_repeat``
times its own words, the excess reshared by weight.  Every document of a source has
the same expected number of copies, target over source size.  Documents are put in
order of size class and a hash of their id; expected copies are summed along that
order from one random offset per source, and a document is emitted once for every
integer boundary the sum crosses.  Ordering by size keeps the words taken near the
target: neighbours in the order are of like size.

Since the expectation is constant within a source, its prefix sum is a rank times a
number.  Ranks come from counts: per class, per hash bucket within a class, and a row
number within a bucket.  A source with a third of all rows is dealt to up to
classes x ``BUCKETS`` groups; no window spans a source's rows.  Built from SQL
functions only; reruns agree.

Defined results: a null or empty text has size 0 and may be taken (0 words); a null
source is a source of its own, after all others; if no text has a word every target
is 0.  Repeated ids are told apart by size; rows alike in both are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import WORD_RE, require_columns, text_or_empty, written

WEIGHTS = (1, 2, 3)       # by source in code point order, repeating
MAX_REPEAT = 3
HEX_DIGITS = 3            # of the id's md5: 4096 buckets within a size class
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD_RE), F.lit(0))).cast("long")


def _size_class(size: Column) -> Column:
    """Monotonous in size, 32 classes for every doubling."""
    digits = F.length(F.bin(size))
    return F.when(size < 32, size).otherwise(
        digits * 32 + F.call_function("shiftright", size, digits - 6).bitwiseAND(31)).cast("int")


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    source = F.col("source").cast("string")
    id_hash = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return (docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(carry)], "doc_id",
                        F.coalesce(F.concat(F.lit("s"), source), F.lit("z")).alias("sk"),
                        source.isNull().alias("no_source"),
                        word_count(text_or_empty()).alias("size"), id_hash.alias("k"))
            .withColumn("cls", _size_class(F.col("size")))
            .withColumn("h", F.substring("k", 1, HEX_DIGITS)))


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sk, source_size, target from sk, source_size (one row per source).

    Sources fill in order of cap over weight: the first whose share of what is left
    fits under its cap ends the filling, and all after it fit too."""
    order = Window.orderBy("no_source", "sk")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.row_number().over(order) - 1) % len(weights) + 1).cast("long")
    weighed = sources.withColumn("w", w).withColumn("cap", F.col("source_size") * max_repeat)
    fill = Window.orderBy(F.col("cap") / F.col("w"), "no_source", "sk")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = (weighed.withColumn("words_left", F.sum("source_size").over(every)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
            .withColumn("at", F.row_number().over(fill)))
    fits = F.col("words_left") * F.col("w") <= F.col("cap") * F.col("w_left")
    level = left.withColumn("level", F.min(F.when(fits, F.struct("at", "words_left", "w_left"))).over(every))
    return level.select("sk", "source_size", F.when(
        F.col("at") < F.col("level.at"), F.col("cap").cast("double")).otherwise(
        (F.col("w") * F.col("level.words_left")).cast("double") / F.col("level.w_left")).alias("target"))


def copies(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Every row's size, source_size, target and number of copies, with the columns
    ``carry`` as ``in_0, in_1, ...`` and ``doc_id``."""
    require_columns(docs, ["doc_id", "text", "source"], "docs")
    rows = _keyed(docs, carry or [])
    groups = written(rows.groupBy("sk", "no_source", "cls", "h")
                     .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-groups")
    sources = groups.groupBy("sk", "no_source").agg(F.sum("words").alias("source_size"))
    aims = written(targets(sources), "mix-targets")

    def before(by: list[str], order: str) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    classes = (groups.groupBy("sk", "cls").agg(F.sum("n").alias("n"))
               .select("sk", "cls", before(["sk"], "cls").alias("class_start")))
    starts = written(groups.select("sk", "cls", "h", before(["sk", "cls"], "h").alias("start"))
                     .join(classes, ["sk", "cls"])
                     .select("sk", "cls", "h", (F.col("start") + F.col("class_start")).alias("start")),
                     "mix-starts")
    within = Window.partitionBy("sk", "cls", "h").orderBy("k", "doc_id", "size")
    ranked = (rows.withColumn("i", F.row_number().over(within)).join(starts, ["sk", "cls", "h"])
              .withColumn("rank", (F.col("start") + F.col("i")).cast("double"))
              .join(aims, "sk"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(SEED), F.col("sk"))), 1, 8), 16, 10).cast("double") / 2**32
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("each") * F.col("rank") + offset) - F.floor(F.col("each") * (F.col("rank") - 1) + offset)
    return (ranked.withColumn("each", each)
            # rounding never lifts a document above its ceiling
            .withColumn("copies", F.least(crossed, F.ceil("each")).cast("long")))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each emitted as often as it is taken, with their own columns."""
    taken = copies(docs, docs.columns)
    return (taken.where("copies > 0")
            .select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)],
                    F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy"))
            .drop("__copy"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target (its source's) and taken words of every row."""
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"))


def oracle_sql() -> str:
    """The report in DuckDB SQL, with one window per source."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
WITH k AS (SELECT doc_id, coalesce('s' || source, 'z') AS sk, source IS NULL AS no_source,
    len(regexp_extract_all(coalesce(text, ''), '{WORD_RE}'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
c AS (SELECT *, CASE WHEN size < 32 THEN size ELSE length(bin(size)) * 32
    + ((size >> (length(bin(size)) - 6)::BIGINT) & 31) END AS cls FROM k),
s AS (SELECT sk, no_source, sum(size)::BIGINT AS source_size FROM c GROUP BY ALL),
w AS (SELECT *, {weights}[(row_number() OVER (ORDER BY no_source, sk) - 1) % {len(WEIGHTS)} + 1] AS w,
    source_size * {MAX_REPEAT} AS cap FROM s),
f AS (SELECT *, row_number() OVER o AS nth,
    (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
    sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
    FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, no_source, sk)),
l AS (SELECT * FROM f WHERE words_left * w <= cap * w_left ORDER BY nth LIMIT 1),
t AS (SELECT f.sk, f.source_size, CASE WHEN f.nth < l.nth THEN f.cap::DOUBLE
    ELSE (f.w * l.words_left)::DOUBLE / l.w_left::DOUBLE END AS target,
    ('0x' || substr(md5('{SEED}' || f.sk), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM f, l),
r AS (SELECT c.doc_id, c.size, t.*, CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE
    ELSE 0.0::DOUBLE END AS e, row_number() OVER (PARTITION BY c.sk
    ORDER BY c.cls, substr(c.k, 1, {HEX_DIGITS}), c.k, c.doc_id, c.size)::DOUBLE AS rank
    FROM c JOIN t ON c.sk = t.sk)
SELECT doc_id, size, source_size, target,
    (size * least(floor(e * rank + u) - floor(e * (rank - 1) + u), ceil(e))::BIGINT)::BIGINT AS taken FROM r"""
