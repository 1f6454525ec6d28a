"""As-of join: every left row with the last right row of its keys at or before its time.

Both sides are merged in time order and the last right row is carried forward, so nothing is
exploded over the ranges in which a right row holds.  The merge is cut into buckets of
``width`` of time: rows are shuffled once, by keys and bucket, so a key with a third of all
rows is as many tasks as it has buckets.  What a bucket needs from before its start is one
row, its carry.  Carries come from the last right row per keys and bucket and from the distinct
buckets of the left side, both partially aggregated: a window over them alone finds the
last one before each bucket.

Defined results: a left row whose keys or time are null, or that no right row precedes, has
null values; right rows with a null key or time are ignored; of right rows with equal keys
and time the greatest values count; left rows are never dropped or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(time: str | Column, micros: int) -> Column:
    c = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(micros)).cast("bigint")


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
               values: list[str], width_days: float = 1.0) -> DataFrame:
    """``left`` with the columns ``values`` of ``right`` added (``by``: equal key columns)."""
    if clash := {v.lower() for v in values} & {c.lower() for c in left.columns}:
        raise ValueError(f"left has columns {sorted(clash)} already")
    micros = max(1, int(width_days * 86_400_000_000))
    keys = [f"k{i}" for i in range(len(by))]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)]
    v = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values)])
    given = F.col(f"`{right_time}`").isNotNull()
    for c in by:
        given = given & F.col(f"`{c}`").isNotNull()

    r = (right.where(given)
         .select(*named, F.col(f"`{right_time}`").cast("timestamp").alias("t"), v.alias("v"))
         .withColumn("bucket", _bucket("t", micros)))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(left.columns)])
    lt = (left.select(*named, F.col(f"`{left_time}`").cast("timestamp").alias("t"), row.alias("row"))
          .withColumn("bucket", _bucket("t", micros)))

    # the last right row before each bucket that holds left rows
    spots = (lt.select(*keys, "bucket").distinct().withColumn("asked", F.lit(True))
             .unionByName(r.groupBy(*keys, "bucket").agg(F.max(F.struct("t", "v")).alias("last")),
                          allowMissingColumns=True)
             .groupBy(*keys, "bucket").agg(F.max("asked").alias("asked"), F.max("last").alias("last")))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (spots.withColumn("carried", F.last("last", ignorenulls=True).over(before))
             .where("asked and carried is not null and bucket is not null")
             .select(*keys, F.col("carried.t").alias("t"), F.col("carried.v").alias("v"), "bucket"))

    # right rows come before left rows of the same time
    merged = (lt.select(*keys, "bucket", "t", F.lit(1).alias("side"), "row")
              .unionByName(r.unionByName(carry).withColumn("side", F.lit(0)), allowMissingColumns=True))
    so_far = (Window.partitionBy(*keys, "bucket").orderBy("t", "side", "v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.when(F.col("t").isNotNull(), F.last("v", ignorenulls=True).over(so_far))
    out = merged.withColumn("held", held).where("side = 1")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(left.columns)],
                      *[F.col(f"held.v{i}").alias(c) for i, c in enumerate(values)])
