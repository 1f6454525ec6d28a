"""The pipeline: its stages one by one on the small tables, awkward and empty input."""
import duckdb
import pytest

import corpus_pipeline as cp
from martlight.llm import mixing, toxicity
from tests.llm.common import SF, WORD, awkward, documents, empty
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        df = stage(spark, docs, SF)
        out.append(df.collect())
        docs = spark.createDataFrame(out[-1], df.schema)
    return out


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "source_mixing",
                                         "best_fit_packing"]
    assert cp.ORACLE_SQL is None and list(cp.QUERIES) == ["pipeline"]


def test_all_but_the_last_keep_the_columns(stages):
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    kept = {r["doc_id"] for r in stages[1]}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept == {d for d, t in documents() if model.score(t or "") < 0.7}
    clean = [d for d, t in toxic.items() if not t]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)


def test_one_document_of_each_near_duplicate_group_stays(stages):
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in stages[1]]
    component = plain_components(fps)
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(set(component.values()))


def test_substring_stage_keeps_clean_documents(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2]}
    after = {r["doc_id"]: r for r in stages[3]}
    assert len(after) >= 0.98 * len(before)
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    first, cut = {}, set()
    for d in sorted(before):                     # a document without a repeated 20-word run is left as it is
        w = before[d].split()
        if any(first.setdefault(tuple(w[i:i + 20]), d) != d for i in range(len(w) - 19)):
            cut.add(d)
    assert all(after[d]["text"] == before[d] for d in before if d not in cut)


def test_mixing_stage_takes_near_its_targets(spark, stages):
    size = lambda r: len(WORD.findall(r["text"] or ""))          # noqa: E731
    docs = spark.createDataFrame(stages[3], ", ".join(f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}"
                                                       for c in COLUMNS))
    out = mixing.report(docs).collect()
    assert sum(r["taken"] for r in out) == sum(map(size, stages[4]))
    assert abs(sum(map(size, stages[4])) - sum(map(size, stages[3]))) < 0.2 * sum(map(size, stages[3]))


def test_packing_stage_holds_every_copy(stages):
    n, least = check_packing(stages[5], [(r["doc_id"], r["text"]) for r in stages[4]])
    assert n <= least * 1.02 + 2


def test_run_equals_the_stages(spark, stages):
    got = cp.run(spark, SF)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got.collect()) == \
        sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[5])


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_and_empty_documents(spark, make):
    docs = make(spark)
    columns = docs.columns
    for name, stage in cp.STAGES:
        df = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert df.columns == columns
        rows = df.collect()
        docs = spark.createDataFrame(rows, df.schema)
    if make is empty:
        assert rows == []
