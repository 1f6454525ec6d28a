"""Combining one-row results without a cross join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side columns of several one-row frames (distinct column names):
    union them with the missing columns NULL, then take each column's single
    non-NULL value.  A column that is NULL in its own frame stays NULL."""
    cols: list[str] = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
