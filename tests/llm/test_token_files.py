"""rANS token files: exact round trips, damage, ranges, awkward rows."""
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlight.llm import queries, rans
from martlight.llm.common import fresh_dir
from martlight.llm.tokens import open_tokenizer
from tests.llm.common import SF, awkward, documents, empty, rows

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


@pytest.mark.parametrize("name,kind", [(WORDS, "words"), (BYTES, "gpt")])
def test_cached_ids_equal_whole_text_ids(name, kind):
    direct, cached = Tokenizer.from_file(P.path(name)), open_tokenizer(P.path(name), kind)
    texts = [t or "" for _, t in documents()[:60]] + [
        "", " ", "\n", "  a  b\n\n c\t d \n", "x   y", "don't I'll 'tis 's", "é ́x", "Σας ΣΑΣ",
        "<|endoftext|> a<|endoftext|>b", "日本 語　テスト", "a\x1cb \x1d c", "x\r\ny", "1234 5.6 a1b2",
        "...! ?!. -- a--b", "«é» ß ÿ Ÿ İI", "a.b,c d|e | f", "tail ", "tail\n", " lead", "\n\nlead"]
    got = list(cached.batches(texts))
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, cached.dtype).tolist() == direct.encode(t, add_special_tokens=False).ids, t


_TEXT = st.lists(st.sampled_from([*"ab AB\n\t.,'!?019éÉßÿ|- ́日", "'s", "ll", "  "]), max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(_TEXT)
def test_cached_ids_on_random_texts(text):
    for name, kind in ((WORDS, "words"), (BYTES, "gpt")):
        c = open_tokenizer(P.path(name), kind)
        assert np.frombuffer(c.batch([text])[0], c.dtype).tolist() == \
            c.tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=0, max_size=3000), st.data())
def test_coder_round_trip_and_ranges(ids, data):
    ids = np.array(ids, dtype=np.uint32)
    seen, counts = np.unique(np.concatenate((ids, [0])), return_counts=True)
    t = rans.Table(seen.astype(np.int64), rans.scale_frequencies(seen, counts))
    words, states, marks = rans.encode(ids, t)
    assert rans.decode(words, states, marks, len(ids), t).tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert rans.decode(words, states, marks, len(ids), t, a, b).tolist() == ids[a:b].tolist()


def test_checkpoints_of_a_long_block_and_compression():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 300_000), 49_000).astype(np.uint32)
    seen, counts = np.unique(ids, return_counts=True)
    t = rans.Table(seen.astype(np.int64), rans.scale_frequencies(seen, counts))
    words, states, marks = rans.encode(ids, t)
    assert len(marks) // (8 * (rans.LANES + 1)) == (len(ids) - 1) // rans.LANES // rans.CHECK_STEPS
    for a, b in ((66_000, 69_000), (131_072, 131_073), (299_999, 300_000), (0, 300_000)):
        assert (rans.decode(words, states, marks, len(ids), t, a, b) == ids[a:b]).all()
    p = counts / counts.sum()
    assert len(words) * 8 < 1.01 * -(counts * np.log2(p)).sum()


def test_frequencies_sum_and_keep_every_token():
    counts = np.array([10**9, 1, 1, 5] + [1] * 5000)
    f = rans.scale_frequencies(np.arange(len(counts)), counts)
    assert f.sum() == 1 << rans.PROB_BITS and f.min() >= 1
    assert rans.scale_frequencies(np.arange(0), np.zeros(0, int)).tolist() == []


def _expected(docs):
    tok = Tokenizer.from_file(P.path(WORDS))
    out, start = [], 0
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_direct_encoding(spark):
    assert sorted(rows(queries.op3_token_files(spark, SF))) == _expected(documents())


def test_awkward_rows_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 50)
    df = awkward(spark)
    path = fresh_dir(spark, "rans-test")
    rans.write(df, path, P.path(WORDS), 2)
    got = rans.read(spark, path, with_ids=True).collect()
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    got = sorted(got, key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == _expected(ordered)
    assert all(len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 2 for r in got)


def test_empty_table(spark):
    assert rows(rans.round_trip(empty(spark), P.path(WORDS), 2)) == []


def test_damaged_block_raises(spark):
    from pyspark.sql import functions as F
    path, other = fresh_dir(spark, "rans-ok"), fresh_dir(spark, "rans-bad")
    rans.write(awkward(spark), path, P.path(WORDS), 2)
    for part in ("table", "parts"):
        spark.read.parquet(f"{path}/{part}").write.parquet(f"{other}/{part}")
    (spark.read.parquet(f"{path}/blocks").withColumn("words", F.expr("overlay(words placing X'FF' from 9)"))
     .write.parquet(f"{other}/blocks"))
    with pytest.raises(Exception, match="CorruptBlock"):
        rans.read(spark, other).collect()
