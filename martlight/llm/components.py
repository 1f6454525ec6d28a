"""Connected components of a link table: large-star and small-star rounds.

Every round is two grouped minima and two joins.  The minima combine in the map
tasks, and each is written before its join, so both join sides are plain
shuffles that adaptive execution can split: a node that holds a third of all
links is no single task.  Rounds end when the links no longer change; their
number grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import written


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _oriented(links: DataFrame) -> DataFrame:
    return (links.where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns ``u``, ``v``);
    ``root`` is the smallest node of its component.  Links from a node to itself and
    null ends are ignored; repeated links count once."""
    e = written(_oriented(links.where("u is not null and v is not null")), "cc-links")
    before = _signature(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        # large star: every neighbour above a node goes to the node's least neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-large")
        e = written(both.join(least, "u").where("v > u and v <> m")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-links")
        # small star: a node and its lower neighbours go to the least of these
        least = written(e.groupBy("u").agg(F.min("v").alias("m")), "cc-small")
        e = written(e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-links")
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
