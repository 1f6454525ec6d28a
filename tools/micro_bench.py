"""Operator micro-benchmark: the distributed forms of dense ranking and
top-N + Others against the single-partition window forms they replace, on
generated rows (operator timing only; not a registered query).

Usage: python tools/micro_bench.py [rows]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _time(fn):
    fn()                                   # warm up
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main(argv):
    n = int(argv[1]) if len(argv) > 1 else 4_000_000
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from martlight.operators.ranking import global_row_number
    from martlight.operators.topn import top_n_with_others
    from martlight.session import local_session
    spark = local_session(8, 16)

    rows = spark.range(n).select(
        (F.xxhash64("id") % 1_000_003).alias("score"), F.col("id").cast("string").alias("label"),
        (F.col("id") % 997).cast("decimal(38,9)").alias("cr"))

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    out = {"rows": n}
    out["rank_distributed_s"] = _time(lambda: noop(
        global_row_number(rows, ["score", "label"], [True, False], "rn", partitions=16)))
    out["rank_single_window_s"] = _time(lambda: noop(rows.withColumn(
        "rn", F.row_number().over(Window.orderBy(F.col("score").desc(), "label")))))
    out["topn_distributed_s"] = _time(lambda: noop(
        top_n_with_others(rows.select("label", "cr"), ["label"], "cr", 10, {"label": "Others"})))
    w = Window.orderBy(F.col("cr").desc_nulls_first(), "label")
    r = rows.select("label", "cr").withColumn("rn", F.row_number().over(w))
    out["topn_single_window_s"] = _time(lambda: noop(
        r.groupBy(F.when(F.col("rn") <= 10, F.col("rn")).otherwise(999999).alias("sort_rn"),
                  F.when(F.col("rn") <= 10, F.col("label")).otherwise("Others").alias("label"))
        .agg(F.sum("cr").alias("cr"))))
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
