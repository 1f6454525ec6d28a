"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. All dates are UTC; ANSI mode
# stays on so bad casts fail instead of silently becoming NULL.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans depend on to an existing session.

    This changes the caller's session, for good: results depend on ANSI mode and UTC.
    Settings that already hold are left alone."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "martlight") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location is read from ``spark.checkpoint.dir``; on a cluster it must
    name storage every executor can reach.  Only when it is unset (local tests)
    a fresh temporary folder is created and registered.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="martlight-ckpt-")      # kept by the context, as set next
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)             # DataFrame.checkpoint() writes here
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def written(df, name: str):
    """``df`` computed once into the shared folder and read back: later plans (and a lost
    executor) start from the files."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below :func:`shared_dir` for one job's output."""
    return shared_dir(spark, f"{name}-{os.getpid()}-{os.urandom(4).hex()}")
