"""Tables in versions, published by one commit step.

A table is a folder with ``data/`` (files, never changed once written) and ``versions/``:
one small manifest per version that lists the folder of every part of the table.  A
rebuild or a refresh first writes its data to a folder of its own and then publishes the
next manifest.  Publishing is the only step that readers can see, and it is exclusive: of
two writers that try the same number one gets :class:`Conflict` and nothing changes.  A
writer that dies before it leaves the old version as it was.

Parts that a refresh does not touch keep their folders, so a new version costs what
changed.  Manifests and their listing are read with Spark; they hold one entry per
part, which bounds what reaches the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WHOLE = "all"             # the part of a table that is rebuilt as a whole


class Conflict(RuntimeError):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Version:
    """What a manifest says: parts by key, the schema as JSON, and the writer's own facts."""
    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    schema: str | None = None
    facts: dict = field(default_factory=dict)


def publish_file(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with ``text`` in one step; raises :class:`Conflict` where it exists."""
    aside = f"{path}.{os.urandom(6).hex()}.part"
    url = urlparse(path)
    if url.scheme in ("", "file"):
        target, aside = (unquote(urlparse(p).path) if url.scheme else p for p in (path, aside))
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(aside, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(aside, target)               # fails where the name is taken
        except FileExistsError:
            raise Conflict(path) from None
        finally:
            os.unlink(aside)
        return
    # other stores: a rename that refuses a taken name, as HDFS does; Spark has no call of its own for it
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    out = fs.create(jvm.org.apache.hadoop.fs.Path(aside), False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(jvm.org.apache.hadoop.fs.Path(aside), target):
        fs.delete(jvm.org.apache.hadoop.fs.Path(aside), False)
        raise Conflict(path)


def _columns(schema: StructType) -> list:
    return [(f.name, f.dataType) for f in schema.fields]


class VersionedTable:
    """The table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- reading ---------------------------------------------------------------
    def version(self, number: int | None = None) -> Version:
        """The newest version, or version ``number``; number 0 (no parts) before the first."""
        glob = "*.json" if number is None else f"{number:012d}.json"
        try:
            rows = (self.spark.read.format("binaryFile").option("pathGlobFilter", glob)
                    .load(f"{self.path}/versions").select("path", "content"))
            newest = rows.agg(F.max_by("content", "path").alias("content")).first()["content"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        if newest is None:
            if number:
                raise ValueError(f"{self.path} has no version {number}")
            return Version()
        return Version(**json.loads(bytes(newest).decode()))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the newest version, or of version ``number``."""
        v = self.version(number)
        if v.schema is None:
            raise ValueError(f"{self.path} has no version yet")
        schema = StructType.fromJson(json.loads(v.schema))
        if not v.parts:
            return self.spark.createDataFrame([], schema)
        folders = sorted(set(v.parts.values()))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    # --- writing ---------------------------------------------------------------
    def publish(self, based_on: Version, parts: dict[str, str], schema: StructType, facts: dict) -> Version:
        """The version after ``based_on``; raises :class:`Conflict` if there is one already."""
        v = Version(based_on.number + 1, parts, schema.json(), facts)
        publish_file(self.spark, f"{self.path}/versions/{v.number:012d}.json", json.dumps(v.__dict__))
        return v

    def rebuild(self, df: DataFrame, facts: dict | None = None, based_on: Version | None = None) -> DataFrame:
        """A new version with the rows of ``df`` alone, read back."""
        base = based_on or self.version()
        folder = f"{base.number + 1:012d}-{os.urandom(6).hex()}"
        df.write.parquet(f"{self.path}/data/{folder}")
        v = self.publish(base, {WHOLE: folder}, df.schema, facts or {})
        return self.read(v.number)

    def replace_parts(self, df: DataFrame, part: str, touched: Iterable[str], facts: dict | None = None,
                      based_on: Version | None = None) -> DataFrame:
        """A new version whose ``touched`` parts hold the rows of ``df`` (by its column ``part``)
        and whose other parts stay as they are; touched parts without rows go."""
        base = based_on or self.version()
        folder = f"{base.number + 1:012d}-{os.urandom(6).hex()}"
        schema = StructType([f for f in df.schema.fields if f.name != part])
        touched = set(touched)
        # one task per part: a part is one file unless Spark splits it for its size
        (df.repartition(F.col(part)).write.partitionBy(part).parquet(f"{self.path}/data/{folder}"))
        full = self.written_parts(folder, part)
        if strange := full - touched:
            raise ValueError(f"rows of parts that are not replaced: {sorted(strange)[:5]}")
        parts = {k: f for k, f in base.parts.items() if k not in touched}
        parts |= {k: f"{folder}/{part}={k}" for k in full}
        v = self.publish(base, parts, schema, facts or {})
        return self.read(v.number)

    def append(self, df: DataFrame, batch: str, number: str | None = None, attempts: int = 5) -> DataFrame:
        """A new version with the rows of ``df`` as a part of its own, named by ``batch``, read back.

        A batch counts once: where the table has a part of that name, nothing is written.
        ``number`` names a column of ``df`` that is dense from 1; it goes on from the rows the
        table has numbered so far, which the version's fact ``last_<number>`` holds.  Of two
        writers that append at once one publishes first; the other takes its numbers anew
        and tries again, at most ``attempts`` times, then :class:`Conflict` is raised."""
        for attempt in range(attempts):
            base = self.version()
            if batch in base.parts:
                return self.read(base.number)
            if base.schema is not None and _columns(StructType.fromJson(json.loads(base.schema))) != _columns(df.schema):
                raise ValueError(f"batch {batch!r} has other columns than {self.path}")
            facts = dict(base.facts)
            last = facts.get(f"last_{number}", 0)
            rows = df if number is None else df.withColumn(number, F.col(number) + F.lit(last).cast("bigint"))
            folder = f"{base.number + 1:012d}-{os.urandom(6).hex()}"
            rows.write.parquet(f"{self.path}/data/{folder}")
            if number is not None:
                done = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{folder}")
                facts[f"last_{number}"] = last + done.count()
            try:
                v = self.publish(base, {**base.parts, batch: folder}, df.schema, facts)
            except Conflict:
                if attempt + 1 == attempts:
                    raise
                continue
            return self.read(v.number)
        raise ValueError("attempts must be positive")

    def written_parts(self, folder: str, part: str) -> set[str]:
        """The keys of the parts that a write has made."""
        rows = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true").load(f"{self.path}/data/{folder}"))
        key = F.regexp_extract("path", f"/{part}=([^/]*)/[^/]*$", 1)
        return {unquote(r["k"]) for r in rows.select(key.alias("k")).distinct().collect() if r["k"]}
