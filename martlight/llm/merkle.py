"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

Sections end at blank lines, paragraphs at line feeds; a paragraph is cut into
pieces of ``PIECE`` code points; other line ends (\\r, U+0085, U+2028, U+2029) are
code points like any other.  A leaf is the SHA-256 of its piece, an inner node
the SHA-256 of its children's digests, so equal roots mean equal texts and a walk
down differing branches locates an edit.  The fingerprint is the tree itself, with
short digests below the root::

    <root, 32 hex>:<piece><piece>...,<piece>...;<piece>...

``;`` parts sections, ``,`` paragraphs; a piece is the first 6 hex digits of its
leaf.  Likeness of two fingerprints needs no text: 1 for equal roots, else the
distinct piece digests they share over the larger tree's number of them (always
below 1).  Built from SQL functions only.

Defined results: a null text is the empty text (one empty leaf); repeated rows get
equal fingerprints; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import pick, text_or_empty

PIECE = 32                # code points of a leaf
_DIGITS = 6               # hex digits of a leaf in the fingerprint


def _tree(text: Column) -> Column:
    """Leaf digests by section, paragraph and piece: array<array<array<string>>>."""
    def leaves(paragraph: Column) -> Column:
        cut = F.when(paragraph == "", F.array(F.lit(""))).otherwise(
            F.regexp_extract_all(paragraph, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
        return F.transform(cut, lambda piece: F.sha2(piece, 256))

    return F.transform(F.split(text, "\n\n+", -1),
                       lambda section: F.transform(F.split(section, "\n", -1), leaves))


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a non-null text.  The root also covers the layout of line feeds,
    so blank-line runs of different lengths differ."""
    def root_of(tree: Column) -> Column:
        sections = F.transform(tree, lambda s: _node(F.transform(s, _node)))
        layout = F.sha2(F.regexp_replace(text, "[^\n]+", "."), 256)
        return F.sha2(F.concat(F.array_join(sections, ""), F.lit("/"), layout), 256)

    def body_of(tree: Column) -> Column:
        def short(paragraph: Column) -> Column:
            return F.array_join(F.transform(paragraph, lambda d: F.substring(d, 1, _DIGITS)), "")
        return F.array_join(F.transform(
            tree, lambda s: F.array_join(F.transform(s, short), ",")), ";")

    # a one-element array binds the tree once for its two uses
    return F.element_at(F.transform(F.array(_tree(text)), lambda tree: F.concat(
        F.substring(root_of(tree), 1, 32), F.lit(":"), body_of(tree))), 1)


def pieces(fp: Column) -> Column:
    """Distinct piece digests of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(F.substring_index(fp, ":", -1),
                                                 F.lit(f"[0-9a-f]{{{_DIGITS}}}"), F.lit(0)))


def root(fp: Column) -> Column:
    return F.substring_index(fp, ":", 1)


def likeness(root_a: Column, root_b: Column, pieces_a: Column, pieces_b: Column) -> Column:
    """0 to 1 from two fingerprints' roots and distinct pieces; 1 only for equal roots."""
    shared = F.size(F.array_intersect(pieces_a, pieces_b)).cast("double")
    most = F.greatest(F.size(pieces_a), F.size(pieces_b), F.lit(1)).cast("double")
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(F.least(shared / most, F.lit(0.999)))


def changed_pieces(a: Column, b: Column) -> Column:
    """Sections and paragraphs (from 0) of ``a`` that do not stand in ``b`` at the same
    place: the branches a walk from the root goes down."""
    def paragraphs(fp):
        return F.transform(F.split(F.substring_index(fp, ":", -1), ";", -1),
                           lambda s: F.split(s, ",", -1))
    x, y = paragraphs(a), paragraphs(b)
    return F.flatten(F.transform(x, lambda s, i: F.filter(
        F.transform(s, lambda p, j: F.when(
            ~F.coalesce(F.get(F.get(y, i), j) == p, F.lit(False)),
            F.struct(i.alias("section"), j.alias("paragraph")))), lambda v: v.isNotNull())))


# --- neighbours -----------------------------------------------------------------

PER_RANGE = 2_000         # rows a range of neighbouring ids is meant to hold
MAX_RANGES = 10_000       # ranges (one literal each); beyond 20 M rows they grow


def with_next(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, text, the columns ``carry`` (expressions of ``text``) and the same of the
    next row in descending ``doc_id`` as ``next_*``; the first row follows the last.

    Rows of one id go by descending text.  Null ids come last, in an order fixed by
    their texts' hashes.  Rows are dealt to ranges of ids and every range is ordered by
    itself; the last row of a range takes the first of the next, one row per range.
    """
    rows = (pick(docs, ["doc_id", "text"], "docs")
            .select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")))
    n = rows.count()
    parts = max(1, min(MAX_RANGES, -(-n // PER_RANGE)))
    cuts: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        got = rows.agg(F.percentile_approx("doc_id", at, 10 * parts).alias("q")).first()["q"] or []
        cuts = sorted(set(got))
    below = F.size(F.filter(F.expr(f"array({','.join(f'{c}L' for c in cuts)})"),
                            lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNotNull(), below)
                           .otherwise(-1 - F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")))
    # one row per range (at most 2 * MAX_RANGES): its largest id, then that row's text, then
    # the range before it
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    firsts = (rows.alias("r").join(F.broadcast(tops).alias("t"), (F.col("r.bucket") == F.col("t.bucket"))
                                   & F.col("r.doc_id").eqNullSafe(F.col("t.top")))
              .groupBy("r.bucket").agg(F.max("r.text").alias("text")))
    ring = Window.orderBy(F.col("bucket").desc())
    extra = carry or {}
    firsts = firsts.select(
        F.coalesce(F.lag("bucket").over(ring), F.min("bucket").over(Window.partitionBy())).alias("bucket"),
        F.struct("text", *[c.alias(k) for k, c in extra.items()]).alias("first"))
    within = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    names = ["text", *extra]
    led = (rows.select("*", *[c.alias(k) for k, c in extra.items()])
           .select("bucket", "doc_id", *names,
                   F.lead(F.struct(*names)).over(within).alias("following")))
    return (led.join(firsts, "bucket")
            .withColumn("following", F.coalesce("following", "first"))
            .select("doc_id", *names, *[F.col("following")[c].alias(f"next_{c}") for c in names]))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last floor(n/3) code points replaced by as many of ``next_text``."""
    n = F.char_length(text)
    k = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(next_text, F.lit(1), k))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and the likeness of the first to
    the second and to the next document's."""
    near = with_next(docs, {"fp": fingerprint(F.col("text"))})
    e = near.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fp", "next_fp",
                    edited(F.col("text"), F.col("next_text")).alias("edited"))
    f = e.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp",
                 fingerprint(F.col("edited")).alias("edited_fp"))
    f = f.select("*", *[pieces(F.col(c)).alias(f"{c}_pieces") for c in ("fp", "edited_fp", "next_fp")])

    def near_to(other: str) -> Column:
        return likeness(root(F.col("fp")), root(F.col(other)),
                        F.col("fp_pieces"), F.col(f"{other}_pieces"))

    return f.select("doc_id", "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"),
                    F.col("edited_fp").alias("edited_fingerprint"),
                    near_to("edited_fp").alias("near_edited"), near_to("next_fp").alias("near_next"))
