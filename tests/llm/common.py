"""Fixtures of the operator tests: awkward rows, and the small tables as Python lists."""
from __future__ import annotations

import re

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# columns that clash with names the operators use inside
EXTRA = ("row", "n", "size", "bucket", "fp", "block", "k", "key", "digest", "score", "removed", "at", "uid")

LONG = " ".join(f"word{i % 977} tail{i % 31}," for i in range(20_000))

AWKWARD = [
    (1, "Plain words here. And one more line\nwith a second paragraph.\n\nA new section.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n ", "de", None),
    (5, "Plain words here. And one more line\nwith a second paragraph.\n\nA new section.", "en", "b"),
    (5, "Plain words here. And one more line\nwith a second paragraph.\n\nA new section.", "en", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " end", None, "c"),
    (8, "Grüße, señor – 日本語 テスト 😀 naïve café", "xx", "c"),
    (None, "a text without an id", "en", "a"),
    (9, "Licensed under the MIT License. mit license MIT-License apache license", "en", "a"),
    (10, "x", "en", "Ünicode"),
]


def awkward(spark, extra: bool = True):
    """AWKWARD as a DataFrame, with extra columns that clash with internal names."""
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in AWKWARD],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in EXTRA])
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents() -> list[tuple]:
    """doc_id, text of the small documents table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
