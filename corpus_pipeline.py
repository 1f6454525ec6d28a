"""A training corpus from the ``documents`` table, in five stages.

Each stage is ``(name, function)``; the function takes (spark, docs, sf_dir) and returns a
DataFrame that :func:`run` writes as Parquet and reads again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``:

1. toxicity: documents predicted toxic go;
2. SimHash near-dedup: one document of each component stays;
3. substring dedup: passages that an earlier document holds are cut out;
4. mixing: documents are emitted as often as their source's target asks;
5. packing: the pieces of all documents in sequences of at most 1024 tokens.

No DuckDB SQL expresses the rows of :func:`run` (tokenizer, fitted classifier, components),
so ``ORACLE_SQL`` is None and tests compare each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlight.llm import cdc, mixing, packing, simhash, toxicity
from martlight.llm.common import fresh_dir, read_table, ship
from martlight.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.deduplicate(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return cdc.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE_SQLS: dict[str, str] = {}
