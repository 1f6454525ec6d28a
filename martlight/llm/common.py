"""Helpers shared by the operators: column checks, written intermediate
tables in the shared folder, and stable row order keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.session import fresh_dir, shared_dir
from martlight.sources.tables import read_table, require_columns

__all__ = ["pick", "numbered", "renamed", "ship", "lean", "HELD", "written", "shared_dir", "fresh_dir", "read_table", "text_or_empty",
           "ASCII_UPPER", "ASCII_LOWER", "lower_ascii", "WORD_RE"]

# The contracts lower-case A-Z only and split words at ASCII white space.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_RE = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, cols: Sequence[str], what: str = "input") -> DataFrame:
    """Only ``cols`` of ``df``: extra columns, whatever their names, never reach
    an operator's joins."""
    require_columns(df, cols, what)
    return df.select(*cols)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    The lineage is cut at storage every executor reaches, so a lost executor
    never causes the plan above to run again, and later consumers read files.
    """
    spark: SparkSession = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    """The columns ``cols`` (all by default) as ``in_0, in_1, ...``: whatever they are
    called, they never clash with an operator's own."""
    return [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(df.columns if cols is None else cols)]


def renamed(cols: Sequence[str]) -> list[Column]:
    """``in_0, in_1, ...`` under the names ``cols`` again."""
    return [F.col(f"in_{i}").alias(c) for i, c in enumerate(cols)]


def text_or_empty(col: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other code point stays."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


# --- memory of Python workers --------------------------------------------------------

ARROW_BYTES = 4 << 20     # of a batch that a task is handed: whole texts may be long

# what tasks keep for the next task of the same Python worker, by operator
HELD: dict[str, dict] = {}


def begin_task(keeps: str | None) -> None:
    """Drop what other operators' tasks left in this worker."""
    for name in [n for n in HELD if n != keeps]:
        del HELD[name]


def end_task() -> None:
    """Hand freed memory back to the system: workers live on, and idle ones count too."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass                                  # another C library: it trims by itself or not at all


def lean(task, keeps: str | None = None):
    """``task`` (over Arrow batches) with nothing left in its worker at the end but
    ``HELD[keeps]``."""
    def run(batches):
        begin_task(keeps)
        try:
            yield from task(batches)
        finally:
            end_task()
    return run


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application, and have Arrow
    batches bounded by bytes, not only by rows.

    The driver packs its own copy and Spark's file server hands it out, as
    ``--py-files`` would; a job started with ``--py-files`` loses nothing.
    """
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if sc.applicationId in _SHIPPED:
        return
    import os
    import zipfile

    from pyspark import SparkFiles

    import martlight
    root = os.path.dirname(os.path.abspath(martlight.__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "package")
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, "martlight_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for here, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(here, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
