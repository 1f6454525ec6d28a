"""The cached tokenizer on batches: pieces looked up once a batch, ids as of whole texts."""
import random

import numpy as np
import public_tokenizers as P
import pytest

from martlight.llm import tokens

FILES = [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "gpt")]


class Counted(tokens._Merged):
    looked_up = 0

    def __getitem__(self, piece):
        Counted.looked_up += 1
        return super().__getitem__(piece)


@pytest.mark.parametrize("name,kind", FILES)
def test_a_piece_is_looked_up_once_a_batch(name, kind):
    c = tokens.CachedTokenizer(P.path(name), kind)
    c.plain = Counted(c.tok, c._pack)
    texts = [" ".join(f"{w}," for w in "some words stand here again and again".split() * 50)] * 40
    Counted.looked_up = 0
    got = c.batch(texts)
    assert Counted.looked_up < 50                # 26 000 pieces, a dozen different ones
    assert got == c._encode(texts)


@pytest.mark.parametrize("name,kind", FILES)
def test_batches_of_mixed_texts_equal_whole_texts(name, kind):
    rng = random.Random(7)
    parts = [*"abz AB\n.,'!?019\u00e9\u00c9\u00df\u00ff\u00c0|-  ", "'s", "'ll", "  ", "the", "\n\n", " of"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(16))) for _ in range(3000)]
    texts += ["", " ", "\n", "a\tb", "\u65e5\u672c \u8a9e", "x\x1cy", "<|endoftext|> a", "." * 50, "tail ", " lead"]
    rng.shuffle(texts)
    c = tokens.CachedTokenizer(P.path(name), kind)
    got = list(c.batches(texts, chars=500))
    want = c.tok.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(x, c.dtype).tolist() for x in got] == [e.ids for e in want]
    assert c.batch([]) == [] and c.batch([""]) == [b""]
