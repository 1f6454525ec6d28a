"""Exact, cached tokenization inside Spark tasks.

The ``tokenizers`` library encodes words, not documents: a text is cut at
places no token can span, and every distinct piece is encoded once per Python
worker.  The ids are those of encoding the whole text (tests compare them).

A plain text (printable ASCII, line feed, precomposed Latin-1 letters, no special
token's string) is cut by the tokenizer's own split pattern.  The plain texts of a
batch are cut and their pieces numbered in Arrow; each distinct one is looked up once
a batch, and a new one goes straight to the merge model.  Any other text is cut more
coarsely, and its pieces go through the whole tokenizer:

* ``"words"`` (white space dropped, word ends marked): at space and line feed.
  Neither joins a token, and neither composes with a following mark under NFC.
* ``"gpt"`` (byte-level pieces with a leading space): before a run of space or
  line feed that follows another character.  A text with any other white space
  is encoded whole, because a run of mixed white space is one token context.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from martlight.llm.common import HELD

CACHE_BYTES = 64 << 20         # of a table of pieces, about; a full table of plain pieces is kept as the older one
_ENTRY = 150                   # bytes of a table's entry beside the piece and its ids

# The split patterns of the two tokenizer files, written for texts
# of printable ASCII, line feed and precomposed Latin-1 letters only.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[\\n\\x20-\\x7e{_LETTER}]*")
_PLAIN_PIECES = {
    "words": re.compile(f"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \\n0-9{_LETTER}]+"),
    "gpt": re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[^ \\n0-9{_LETTER}]+"
                      r"|[ \n]+(?![^ \n])|[ \n]+"),
}
_MARKS = [chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]
_DIGITS = "0123456789"
_SPACE_RUNS = ("  ", " \n", "\n ", "\n\n")


def _parted(text: str, kind: str) -> str:
    """A plain text, which holds no tab, with tabs between its pieces; for "words" white space
    parts them too.  Some pieces are empty.

    Single marks are parted by replacing them.  The split pattern cuts texts with marks side
    by side or quotes; for "gpt" also with digits and white space in other places."""
    if "'" not in text:
        out = text
        for c in _MARKS:
            if c in out:
                out = out.replace(c, f"\t{c}\t")
        if "\t\t" not in out:
            if kind == "words":
                for c in _DIGITS:
                    if c in out:
                        out = out.replace(c, f"\t{c}\t")
                return out
            if not (" \t" in out or any(c in out for c in _DIGITS) or any(r in out for r in _SPACE_RUNS)):
                return out.replace(" ", "\t ").replace("\n", "\t\n\t")
    return "\t".join(_PLAIN_PIECES[kind].findall(text))


# any other text
_PIECES = {"words": re.compile(r"[^ \n]+"), "gpt": re.compile(r"[ \n]*[^ \n]+|[ \n]+")}
_OTHER_SPACE = re.compile(r"[^\S \n]")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    other bytes for the code points from 256 on, in ascending order."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Merged(dict):
    """Ids by piece of a plain text; a new piece goes to the merge model at once.  ``older`` is
    the table before: what is used again moves on from there."""

    def __init__(self, tok, pack):
        super().__init__()
        self.run, self.pack, self.size, self.older = tok.model.tokenize, pack, 0, {}
        self.letters = "".join(v for _, v in sorted(_byte_letters().items()))

    def renew(self) -> None:
        """Begin a new table if this one is full."""
        if self.size > CACHE_BYTES:
            self.older = dict(self)
            self.clear()
            self.size = 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._merge(piece)
        self[piece] = ids
        self.size += _ENTRY + len(piece) + len(ids)
        return ids

    def _merge(self, piece: str) -> bytes:
        if piece.isalpha() and piece.isascii():
            word = piece                       # stands for itself byte by byte
        else:
            word = piece.encode().decode("latin-1").translate(self.letters)
        return self.pack([t.id for t in self.run(word)])


class CachedTokenizer:
    """Ids of a text as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.kind = kind
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.dtype = np.dtype(f"<u{self.width}")
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.plain = _Merged(self.tok, self._pack)
        self.other: dict[str, bytes] = {}        # by piece of any other text
        self.other_size = 0

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e.ids)
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each plain text."""
        self.plain.renew()
        self.plain[""] = b""
        parted = pa.array([_parted(t, self.kind) for t in texts], pa.large_string())
        pieces = (pc.ascii_split_whitespace(parted) if self.kind == "words"
                  else pc.split_pattern(parted, "\t"))
        coded = pieces.values.dictionary_encode()
        found = list(map(self.plain.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        code = coded.indices.to_numpy()
        # ids of the distinct pieces side by side, then each piece's taken from there
        ids = np.frombuffer(b"".join(found), dtype=self.dtype)
        n = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        at, count = np.cumsum(n) - n, n[code]
        ends = np.concatenate(([0], np.cumsum(count)))
        take = np.repeat(at[code] - ends[:-1], count)
        take += np.arange(ends[-1])
        raw = ids[take].tobytes()
        cuts = (ends[pieces.offsets.to_numpy()] * self.width).tolist()
        return [raw[a:z] for a, z in zip(cuts, cuts[1:])]

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text (no end id)."""
        if self.other_size > CACHE_BYTES:
            self.other.clear()
            self.other_size = 0
        out: list[bytes | None] = [None] * len(texts)
        cut: list[tuple[int, list[str]]] = []
        plain: list[int] = []
        whole: list[int] = []
        new: set[str] = set()
        words = self.kind == "words"
        find = _PIECES[self.kind].findall
        for i, t in enumerate(texts):
            if _PLAIN.fullmatch(t) and not any(s in t for s in self.special):
                plain.append(i)
            elif not words and _OTHER_SPACE.search(t):
                whole.append(i)
            else:
                p = find(t)
                cut.append((i, p))
                new.update(set(p).difference(self.other))
        if plain:
            for i, ids in zip(plain, self._plain_ids([texts[i].lower() if words else texts[i] for i in plain])):
                out[i] = ids
        if new:
            found = self._encode(list(new))
            self.other.update(zip(new, found))
            self.other_size += sum(map(len, new)) + sum(map(len, found)) + _ENTRY * len(new)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]) if whole else ()):
            out[i] = ids
        for i, p in cut:
            out[i] = b"".join(map(self.other.__getitem__, p))
        return out

    def batches(self, texts: list[str], chars: int = 4_000_000):
        """:meth:`batch` over runs of at most ``chars`` characters (or one text)."""
        run: list[str] = []
        size = 0
        for t in texts:
            if run and size + len(t) > chars:
                yield from self.batch(run)
                run, size = [], 0
            run.append(t)
            size += len(t)
        if run:
            yield from self.batch(run)


def open_tokenizer(path: str, kind: str) -> CachedTokenizer:
    """One tokenizer per Python worker and file."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    kept = HELD.setdefault("tokens", {})
    if (path, kind) not in kept:
        kept[path, kind] = CachedTokenizer(path, kind)
    return kept[path, kind]


def crc_u32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
