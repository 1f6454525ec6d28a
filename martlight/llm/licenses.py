"""License scan by diagonal voting.

Templates are word sequences of license phrases, notices, body passages and SPDX headers.  Every rolling word
2-gram of every text is joined, by hash, to the templates' 2-grams; each hit votes
for the diagonal (text position minus template position).  Votes are counted per
text, template and diagonal; neighbouring diagonals (a word inserted or dropped)
are merged; a merged span is verified by the words themselves: the share of the
template's words that stand in the span.  Built from SQL functions only.

Base phrases must stand word for word: their diagonals need every 2-gram of the
phrase, and each such place is counted.  Notices need all their words but one in
``MISS`` in a span at most ``SLACK`` words longer or shorter.

The templates are a fixed table in this module, so the join's small side has a fixed
size.  What is shuffled is hits and one row per text, never words.

Defined results: a null or empty text has no words and no labels; repeated rows are
scanned row by row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.llm.common import lower_ascii, pick, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MISS = 8                  # one in so many of a notice's words may be missing from its span
SLACK = 2                 # words inserted or dropped between merged diagonals

# The contract's phrases and their labels.
BASE_PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Notices the method adds, in the words licenses and SPDX headers use.
NOTICES = [
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license version", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("mozilla public license version", "mpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("creative commons attribution", "cc"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("all rights reserved", "proprietary"),
    ("spdx license identifier", "spdx"),
]

# Passages of license bodies, and the names licenses go by.  Texts that differ in one word
# (a program, a library) are held up to that word, so no miss can blur them.
PASSAGES = [
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("to deal in the software without restriction including without limitation the rights", "mit"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache"),
    ("each contributor hereby grants to you a perpetual worldwide non exclusive no charge", "apache"),
    ("you may obtain a copy of the license at http www apache org", "apache"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("nor the names of its contributors may be used to endorse or promote products", "bsd"),
    ("bsd 2 clause license", "bsd"),
    ("bsd 3 clause license", "bsd"),
    ("this program is free software you can", "gpl"),
    ("this library is free software you can", "lgpl"),
    ("interacting with it remotely through a computer network", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("eclipse public license v", "epl"),
    ("the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("cc0 1 0 universal", "cc0"),
    ("boost software license version 1 0", "boost"),
    ("the origin of this software must not be misrepresented", "zlib"),
]

# SPDX identifiers by the words that follow the header.
SPDX_IDS = [
    ("mit", "mit"), ("apache 2 0", "apache"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("isc", "isc"),
    ("gpl 2 0", "gpl"), ("gpl 3 0", "gpl"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"), ("agpl 3 0", "agpl"),
    ("mpl 2 0", "mpl"), ("epl 2 0", "epl"), ("unlicense", "unlicense"), ("cc0 1 0", "cc0"), ("bsl 1 0", "boost"),
    ("zlib", "zlib"),
]


def notices() -> list[tuple[str, str]]:
    """(words, label) of all the method adds."""
    return [*NOTICES, *PASSAGES, *((f"spdx license identifier {i}", label) for i, label in SPDX_IDS)]

# 2-grams of these words alone are no sign of a license and are not indexed.
COMMON = ["a", "and", "any", "by", "in", "is", "of", "or", "the", "to", "under", "use", "with"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def template_grams() -> list[tuple]:
    """(template, label, base, words, position, word, next word) of every indexed 2-gram."""
    rows = []
    for base, table in ((True, BASE_PHRASES), (False, notices())):
        for phrase, label in table:
            w = phrase.split()
            rows += [(phrase, label, base, len(w), i, w[i], w[i + 1]) for i in range(len(w) - 1)
                     if base or not (w[i] in COMMON and w[i + 1] in COMMON)]
    return rows


def templates_sql() -> str:
    """The template table as rows of SQL literals (plain ASCII words only)."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v).lower()
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in template_grams())


def templates(spark: SparkSession) -> DataFrame:
    """gram, template, label, base, t_words, t_at: one row per indexed 2-gram position."""
    return spark.sql(
        "SELECT xxhash64(a, b) AS gram, template, label, base, t_words, t_at "
        f"FROM VALUES {templates_sql()} AS t(template, label, base, t_words, t_at, a, b)")


def hits(docs: DataFrame) -> DataFrame:
    """One row per text position that a template 2-gram hits, and one for a text without
    hits: row, doc_id, n, at, the template's columns and ``near``, the words that a
    span on the hit's diagonal may take."""
    spark = docs.sparkSession
    rows = template_grams()                                 # a fixed table
    known = templates(spark)
    indexed = [r["gram"] for r in known.select("gram").distinct().collect()]
    reach = max(r[4] for r in rows) + SLACK                 # words before a hit that a span may take
    width = reach + max(r[3] for r in rows) + 2 * SLACK

    def found_in(w: Column) -> Column:
        def gram(i: Column) -> Column:
            return F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1))
        # places are filtered within the array; a hit carries the words around it, not the text
        places = F.when(F.size(w) > 1, F.filter(F.sequence(F.lit(1), F.size(w) - 1), lambda i: gram(i).isin(*indexed)))
        return F.struct(F.size(w).alias("n"), F.transform(places, lambda i: F.struct(
            (i - 1).alias("at"), gram(i).alias("gram"),
            F.slice(w, F.greatest(i - reach, F.lit(1)), F.lit(width)).alias("around"))).alias("hits"))

    # a one-element array binds the words once for their uses
    texts = (pick(docs, ["doc_id", "text"], "docs")
             .select(F.monotonically_increasing_id().alias("row"), "doc_id",
                     F.element_at(F.transform(F.array(words(text_or_empty())), found_in), 1).alias("found"))
             .select("row", "doc_id", F.col("found.n").alias("n"), F.explode_outer("found.hits").alias("hit"))
             .select("row", "doc_id", "n", "hit.at", "hit.gram", "hit.around"))
    # word ``at - t_at - SLACK`` (0 at least) in the words around the hit, which begin at ``begin``
    begin = F.greatest(F.col("at") + 1 - reach, F.lit(1)) - 1
    start = F.greatest(F.col("at") - F.col("t_at") - SLACK, F.lit(0)) - begin + 1
    return (texts.join(F.broadcast(known), "gram", "left")
            .select("row", "doc_id", "n", "at", "template", "label", "base", "t_words", "t_at",
                    F.when(F.col("template").isNotNull(),
                           F.slice("around", start, F.col("t_words") + 2 * SLACK)).alias("near")))


def spans(found: DataFrame) -> DataFrame:
    """Merged diagonals, verified: row, doc_id, n, template, label, diagonal, covered,
    exact (a base phrase), notice.  A text without hits has one row, template null."""
    text, kind = ["row", "doc_id", "n"], ["template", "label", "base", "t_words"]
    votes = (found.groupBy(*text, *kind, (F.col("at") - F.col("t_at")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.max("near").alias("near")))
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    before = F.lag("diagonal").over(by)
    merged = (votes.withColumn("new", (F.col("base") | before.isNull()
                                       | (F.col("diagonal") - before > SLACK)).cast("int"))
              .withColumn("span", F.sum("new").over(by)))
    target = F.array_distinct(F.split("template", " "))
    shared = F.size(F.array_intersect(target, F.col("near")))
    enough = F.greatest(F.floor((F.col("t_words") - 1) / 2), F.lit(2))
    return (merged.groupBy(*text, *kind, "span")
            .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("diagonal"),
                 F.flatten(F.collect_list("near")).alias("near"))
            .withColumn("shared", shared).withColumn("all", F.size(target))
            .select(*text, "template", "label", "diagonal", (F.col("shared") / F.col("all")).alias("covered"),
                    F.coalesce(F.col("base") & (F.col("votes") == F.col("t_words") - 1),
                               F.lit(False)).alias("exact"),
                    F.coalesce(~F.col("base") & (F.col("votes") >= enough) & (
                        F.col("shared") >= F.col("all") - F.floor(F.col("t_words") / MISS)), F.lit(False)).alias("notice")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    exact, found = F.col("exact"), F.col("exact") | F.col("notice")

    def names(ok: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("label")))), ",")

    return (spans(hits(docs)).groupBy("row", "doc_id", "n").agg(
        F.sum(exact.cast("long")).alias("n_base"),
        F.min(F.when(exact, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("diagonal"))).cast("long").alias("last_word"),
        names(exact).alias("base_labels"), names(found).alias("labels"),
        F.max(F.when(exact, 1.0).when(F.col("notice"), F.col("covered")).otherwise(0.0)).alias("score"))
        .select("doc_id", F.col("n").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                "base_labels", "labels", "score"))


def oracle_sql() -> str:
    """The scan in DuckDB SQL, joined by the words themselves."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH t AS (SELECT * FROM (VALUES {templates_sql()}) AS v(template, label, base, t_words, t_at, a, b)),
x AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT r, w, unnest(range(0, len(w) - 1)) AS at FROM x WHERE len(w) > 1),
h AS (SELECT g.r, t.*, g.at - t.t_at AS diagonal,
        list_slice(g.w, greatest(g.at - t.t_at - {SLACK}, 0) + 1,
                   greatest(g.at - t.t_at - {SLACK}, 0) + t_words + {2 * SLACK}) AS near
      FROM g JOIN t ON g.w[g.at + 1] = t.a AND g.w[g.at + 2] = t.b),
v AS (SELECT r, template, label, base, t_words, diagonal, count(*) AS votes, any_value(near) AS near
      FROM h GROUP BY ALL),
m AS (SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER d <= {SLACK} IS NOT TRUE THEN 1 ELSE 0 END
        AS new FROM v WINDOW d AS (PARTITION BY r, template ORDER BY diagonal)),
s AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM m),
u AS (SELECT r, template, label, base, t_words, span, sum(votes) AS votes, min(diagonal) AS diagonal,
        flatten(list(near)) AS near FROM s GROUP BY ALL),
c AS (SELECT *, len(list_intersect(list_distinct(string_split(template, ' ')), near)) AS shared,
        len(list_distinct(string_split(template, ' '))) AS words FROM u),
k AS (SELECT *, shared / words AS covered, base AND votes = t_words - 1 AS exact, NOT base
        AND shared >= words - t_words // {MISS} AND votes >= greatest((t_words - 1) // 2, 2) AS notice FROM c),
p AS (SELECT r, count(*) FILTER (exact) AS n_base, min(diagonal) FILTER (exact) AS first_word,
        max(diagonal) FILTER (exact) AS last_word,
        list_sort(list(DISTINCT label) FILTER (exact)) AS base_labels,
        list_sort(list(DISTINCT label) FILTER (exact OR notice)) AS labels,
        max(CASE WHEN exact THEN 1.0::DOUBLE WHEN notice THEN covered ELSE 0.0 END) AS score
      FROM k GROUP BY r)
SELECT x.doc_id, len(x.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM x LEFT JOIN p USING (r)"""
