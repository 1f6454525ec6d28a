"""One thin query per operator, under the names ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.llm import licenses, mixing
from martlight.llm.common import read_table, ship

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file lies (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; held-out rows are never learned from."""
    from martlight.llm import toxicity
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                         "score", "predicted")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: given rules, then mined association rules."""
    from martlight.llm import url_rules
    return url_rules.judge(read_table(spark, sf_dir, "pages", ["page_id", "url"]))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    from martlight.llm import rans
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return rans.round_trip(docs, tokenizer_path("word_bpe_49k.json"), end_id=2, kind="words")


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of all documents against edited and neighbouring texts."""
    from martlight.llm import merkle
    return merkle.compare(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sample of all documents to the sources' target weights."""
    return mixing.report(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    from martlight.llm import packing
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th vector, among all."""
    from martlight.llm import ann
    ship(spark)
    return ann.nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding",
                       lambda i: i % 50 == 0)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that an earlier document holds."""
    from martlight.llm import cdc
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", "text")
    return cdc.without_repeats(docs)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    from martlight.llm import simhash
    ship(spark)
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return licenses.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic word runs of all documents, every tenth of which repeats a stretch to its end."""
    from martlight.llm import periodic
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", "text")
    return periodic.digests(periodic.with_runs(docs, periodic.repeat_tail))


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens that hold every source's share."""
    from martlight.llm import mixture
    ship(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mixture.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some with a letter left out, with their near words' forms."""
    from martlight.llm import spelling
    ship(spark)
    return spelling.variants(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), spelling.drop_letter)


QUERIES: dict[str, QueryFn] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_rules": op2_url_rules,
    "op3_token_files": op3_token_files,
    "op4_merkle": op4_merkle,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_ann": op7_ann,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_mixture_packing": op12_mixture_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQLS: dict[str, str] = {
    "op5_mixing": mixing.oracle_sql(),
    "op10_licenses": licenses.oracle_sql(),
}
