"""Typed tables and writes: create a table from a declared schema, conform a
DataFrame to it, overwrite (full rebuild) or append (``INSERT … SELECT``).

Paths are caller-given; on a cluster they name shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types; a
    declared column the frame lacks becomes a typed NULL.  Casting is ANSI:
    a value that does not fit fails the job instead of turning NULL."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(src) if src is not None else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_table(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE: an empty table with exactly ``schema``."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def overwrite(df: DataFrame, path: str, schema: StructType | None = None,
              partition_by: list[str] | None = None) -> None:
    w = (conform(df, schema) if schema is not None else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, schema: StructType) -> None:
    """INSERT INTO … SELECT: rows conformed to the table's declared schema."""
    conform(df, schema).write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write the rendered report row(s) (subject, body) as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
