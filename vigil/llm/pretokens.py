"""Texts of an Arrow column cut into word pieces, a block of texts at a time.

The two patterns below are written as boundary rules over character classes,
so a block is cut with a few array operations. All pieces of a block are then
one Arrow array over the block's own bytes, and ``dictionary_encode`` gives
its distinct words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Unicode White_Space (fixed values)
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: bytes of text that are cut together
BLOCK_BYTES = 2 << 20


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                      np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, pa.Buffer, np.ndarray]]:
    """Row ranges of about ``most`` bytes: first row, row after the last, the
    rows' bytes, and the byte offset of each row (one more at the end). A null
    text is empty. A longer text stands alone."""
    texts = pa.array([], pa.large_string()) if not len(texts) else texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, j, data.slice(int(offs[i]), int(offs[j] - offs[i])), offs[i:j + 1] - offs[i]
        i = j


def code_points(data: pa.Buffer, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a block, the byte offset of each (one more at the end),
    and the index of each row's first one (one more at the end)."""
    cps = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
    if len(cps) == data.size:
        return cps, np.arange(len(cps) + 1), offs
    width = 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)
    at = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    return cps, at, np.searchsorted(at, offs)


def _runs(cps: np.ndarray, rows: np.ndarray):
    cls = classes()[cps]
    n = len(cps)
    first = np.zeros(n + 1, bool)
    first[rows] = True
    change = np.ones(n, bool)
    change[1:] = cls[1:] != cls[:-1]
    change |= first[:n]
    return cls, first, change


def _contractions(cps, first, change, lone, starts):
    """Apply 's 't 'm 'd 're 've 'll at the apostrophes ``lone``, each the
    start of a match and followed by a letter of the same row."""
    n = len(cps)
    c1 = cps[lone + 1]
    short = lone[np.isin(c1, [ord(c) for c in "stmd"])]
    starts[short + 1] = False
    starts[short[short + 2 < n] + 2] = True
    far = lone[lone + 2 < n]
    far = far[~first[far + 2]]
    c1, c2 = cps[far + 1], cps[far + 2]
    e, v, r, ell = ord("e"), ord("v"), ord("r"), ord("l")
    far = far[((c2 == e) & ((c1 == r) | (c1 == v))) | ((c1 == ell) & (c2 == ell))]
    starts[far + 1] = False
    starts[far + 2] = False
    starts[far[far + 3 < n] + 3] = True


def _lone_apostrophes(cps, cls, first, change):
    at = np.flatnonzero(cps == 39)
    at = at[at + 1 < len(cps)]
    return at[change[at] & ~first[at + 1] & (cls[at + 1] == LETTER)]


def starts_with_spaces(cps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Starts of the matches of the pattern of byte-level vocabularies
    (contractions, then letters, numbers or others with one space before, then
    white space without its last character before a non-space). Every
    character lies in a match."""
    cls, first, change = _runs(cps, rows)
    n = len(cps)
    inked = cls != SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (cps[:-1] == 32) & ~first[1:n]
    starts = change & ~(inked & after_blank)
    starts[:-1] |= ~inked[:-1] & inked[1:] & ~first[1:n]
    lone = _lone_apostrophes(cps, cls, first, change)
    _contractions(cps, first, change, lone[~after_blank[lone]], starts)
    return np.flatnonzero(starts)


def starts_of_words(cps: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of contractions, letter runs, single numbers and other runs, and
    of the white space between them; True where a start is a word."""
    cls, first, change = _runs(cps, rows)
    starts = change | (cls == NUMBER)
    _contractions(cps, first, change, _lone_apostrophes(cps, cls, first, change), starts)
    at = np.flatnonzero(starts)
    return at, cls[at] != SPACE


def distinct(data, byte_starts: np.ndarray, size: int) -> tuple[np.ndarray, list[bytes]]:
    """Index of each piece into the distinct pieces, and those."""
    offs = np.append(byte_starts, size).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(offs), data])
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


class WordIds:
    """Ids of distinct words, kept for later blocks of the same task in a
    table of at most ``most`` words; others are replayed again."""

    def __init__(self, table, most: int = 150_000):
        self.table, self.most = table, most
        self.at: dict[bytes, int] = {}
        self.ids = np.empty(1 << 20, np.int32)
        self.offs = [0]

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, length): word i has ids[begin[i]:begin[i] + length[i]]."""
        from vigil.llm.bpe import replay
        get = self.at.get
        slot = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(slot < 0)
        new = [words[i] for i in missing.tolist()]
        ids, offs = replay(self.table, new)
        used = self.offs[-1]
        all_ids = np.concatenate([self.ids[:used], ids])
        known = np.asarray(self.offs, np.int64)
        begin, length = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        old = slot >= 0
        begin[old] = known[slot[old]]
        length[old] = known[slot[old] + 1] - begin[old]
        begin[missing] = used + offs[:-1]
        length[missing] = np.diff(offs)
        room = max(0, self.most - len(self.at))
        keep = min(room, len(new))
        if keep:
            base = len(self.at)
            for k in range(keep):
                self.at[new[k]] = base + k
            self.offs.extend((used + offs[1:keep + 1]).tolist())
            end = used + int(offs[keep])
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids[:used], np.empty(2 * end - used, np.int32)])
            self.ids[used:end] = ids[:end - used]
        return all_ids, begin, length


def gather(ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids[begin[i]:begin[i] + length[i]] one after another, and the offset of
    each (one more at the end)."""
    offs = np.concatenate([[0], np.cumsum(length)])
    return ids[np.arange(offs[-1]) + np.repeat(begin - offs[:-1], length)], offs
