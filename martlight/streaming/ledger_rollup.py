"""Incremental ledger cube with Structured Streaming.

The batch report aggregates the ledger to ``(day, service_type, name) -> credits`` for its
window.  At scale the same cube can be kept up to date as ledger files arrive: every
micro-batch is aggregated by itself and its partial sums are written as one folder of the
cube table (``batch=<id>/day=<day>``).  Readers add the partial sums of a day.

Nothing waits for a watermark and no state is held: a row counts as soon as its batch is
done, however late it is, and belongs to the day it names.  A batch that runs again after a
failure overwrites its own folder, so each row counts once.  All service types are kept
(the report applies its family).

After its sums a batch writes the names of the files it has read beside the table
(``<out_dir>-files``), so :func:`incomplete_days` can tell the days of which landed rows are
still to come.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martlight.session import shared_dir

CREDITS = "decimal(38,9)"
CUBE = "day date, service_type string, name string, credits decimal(38,9)"


def ledger_rollup(ledger: DataFrame) -> DataFrame:
    """Ledger rows to daily cube rows (day, service_type, name, credits)."""
    return (ledger.groupBy(F.to_date("start_time").alias("day"), "service_type", "name")
            .agg(F.sum("credits_used").cast(CREDITS).alias("credits")))


_FILE = "__file"           # added to the source's rows: the file a row stands in


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_FILE, F.col("_metadata.file_path"))


def _files_dir(out_dir: str) -> str:
    return out_dir.rstrip("/") + "-files"


def start_rollup(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream parquet ledger files from ``source_dir`` into the cube table at ``out_dir``.

    The checkpoint defaults to a folder below the cluster's ``spark.checkpoint.dir``; one
    checkpoint belongs to one ``out_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def add(batch: DataFrame, batch_id: int) -> None:
        # the files' names come last: they stand for sums that are complete
        (ledger_rollup(batch).write.mode("overwrite").partitionBy("day")
         .parquet(f"{out_dir}/batch={batch_id}"))
        (batch.select(F.col(_FILE).alias("file")).distinct()
         .write.mode("overwrite").parquet(f"{_files_dir(out_dir)}/batch={batch_id}"))

    w = (_with_file(reader.parquet(source_dir)).writeStream.foreachBatch(add)
         .option("checkpointLocation", checkpoint or shared_dir(spark, "ledger_rollup_ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_cube(spark: SparkSession, out_dir: str, lo=None, hi=None) -> DataFrame:
    """The cube (day, service_type, name, credits), of days ``lo..hi`` if given: only
    those partitions are read."""
    rows = spark.read.schema(CUBE + ", batch bigint").parquet(out_dir)
    if lo is not None:
        rows = rows.filter(F.col("day") >= F.lit(lo))
    if hi is not None:
        rows = rows.filter(F.col("day") <= F.lit(hi))
    return (rows.groupBy("day", "service_type", "name")
            .agg(F.sum("credits").cast(CREDITS).alias("credits")))


def incomplete_days(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                    lo=None, hi=None) -> DataFrame:
    """(day, rows, files): days, from ``lo`` to ``hi`` if given, of which rows have landed in
    ``source_dir`` that no finished batch of the cube at ``out_dir`` has read; empty where the
    cube is up to date.  Rows are counted per day and file before the join."""
    rows = _with_file(spark.read.schema(schema).parquet(source_dir)).withColumn("day", F.to_date("start_time"))
    if lo is not None:
        rows = rows.filter(F.col("day") >= F.lit(lo))
    if hi is not None:
        rows = rows.filter(F.col("day") <= F.lit(hi))
    per_file = rows.groupBy("day", _FILE).agg(F.count(F.lit(1)).alias("rows"))
    try:
        seen = spark.read.schema("file string, batch bigint").parquet(_files_dir(out_dir))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":     # no batch has finished yet
            raise
        seen = spark.createDataFrame([], "file string")
    unread = per_file.join(seen, F.col(_FILE) == F.col("file"), "left_anti")
    return unread.groupBy("day").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))
