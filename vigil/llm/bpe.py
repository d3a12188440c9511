"""Byte-pair merges replayed over all distinct words of a block at once.

``MergeTable`` holds a vocabulary's merges: which pair of ids joins, at which
rank, into which id. ``replay`` lays the distinct words of a block side by
side, keeps an inverted index from merge rank to the positions where that pair
stands, and applies every merge in rank order; a merge changes only its two
neighbouring pairs, which are re-ranked and added to the index. The result of
a word does not depend on the other words of the block.
"""

from __future__ import annotations

import base64
import heapq
import json
from functools import lru_cache

import numpy as np

#: bits that hold one id in a pair key
ID_BITS = 20
#: merge ranks are looked up in the inverted index by bands of 2**BAND_BITS
BAND_BITS = 10


class MergeTable:
    """first/last: id of each byte inside a word and as its last byte;
    pairs: key of two ids -> rank; made: new id of each rank; whole: words that
    are taken as they are, before any merge; tokens: bytes of each id."""

    def __init__(self, first, last, pairs, made, whole, tokens):
        self.first = np.asarray(first, np.int32)
        self.last = np.asarray(last, np.int32)
        self.made = np.asarray(made, np.int32)
        self.pairs, self.whole, self.tokens = pairs, whole, tokens
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, -1, np.int64)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int64, len(pairs))
        at = self._slot(keys)
        while len(keys):  # open addressing: who finds a slot free and wins it stays
            free = np.flatnonzero(self.slot_key[at] < 0)
            self.slot_key[at[free]] = keys[free]
            left = self.slot_key[at] != keys
            won = ~left
            self.slot_rank[at[won]] = ranks[won]
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where it never joins."""
        keys = (a.astype(np.int64) << ID_BITS) | b
        at = self._slot(keys)
        found = self.slot_key[at]
        out = np.where(found == keys, self.slot_rank[at], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slot_key[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    @staticmethod
    @lru_cache(maxsize=2)
    def from_ranks(path: str) -> "MergeTable":
        """A tiktoken rank file: a pair joins if the joined bytes are a token."""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << ID_BITS | b] = rank
        ids = [ranks[bytes([b])] for b in range(256)]
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        return MergeTable(ids, ids, pairs, range(len(tokens)), ranks, tokens)

    @staticmethod
    @lru_cache(maxsize=2)
    def from_word_end_json(path: str) -> "MergeTable":
        """A tokenizers BPE file over byte characters with a word-end suffix."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = byte_characters()
        pairs, made = {}, []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault(vocab[a] << ID_BITS | vocab[b], len(made))
            made.append(vocab[a + b])
        return MergeTable([vocab[c] for c in chars], [vocab[c + end] for c in chars],
                          pairs, made, {}, None)


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for a byte:
    itself where it is printable Latin-1, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return [out[b] for b in range(256)]


def replay(table: MergeTable, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the offset of each word (one more at the
    end). Words are not empty."""
    whole = table.whole
    fixed = [whole.get(w) for w in words] if whole else [None] * len(words)
    todo = [w for w, f in zip(words, fixed) if f is None]
    ids, offs = _replay(table, todo)
    if not whole:
        return ids, offs
    known = np.fromiter((f is not None for f in fixed), bool, len(fixed))
    lengths = np.ones(len(words), np.int64)
    lengths[~known] = np.diff(offs)
    out_offs = np.concatenate([[0], np.cumsum(lengths)])
    out = np.empty(out_offs[-1], np.int32)
    at = np.repeat(known, lengths)
    out[at] = [f for f in fixed if f is not None]
    out[~at] = ids
    return out, out_offs


def _replay(table: MergeTable, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if not words:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(words), np.uint8)
    start_sym = table.first[data]
    start_sym[ends - 1] = table.last[data[ends - 1]]
    n = len(data)
    sym = start_sym.copy()
    word = np.repeat(np.arange(len(words)), lengths)
    nxt = np.arange(1, n + 1)
    nxt[ends - 1] = -1
    prv = np.arange(-1, n - 1)
    prv[ends[:-1]] = -1
    rank_at = np.full(n, -1, np.int64)
    at = np.flatnonzero(nxt >= 0)
    rank_at[at] = table.rank(sym[at], sym[at + 1])

    #: the inverted index: band of merge ranks -> positions of its pairs
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def add(positions: np.ndarray) -> None:
        bands = rank_at[positions] >> BAND_BITS
        order = np.argsort(bands, kind="stable")
        positions, bands = positions[order], bands[order]
        begins = np.flatnonzero(np.append(True, bands[1:] != bands[:-1]))
        cuts = [*begins.tolist(), len(order)]
        for band, i, j in zip(bands[begins].tolist(), cuts, cuts[1:]):
            if band in index:
                index[band].append(positions[i:j])
            else:
                index[band] = [positions[i:j]]
                heapq.heappush(queue, band)

    if (rank_at >= 0).any():
        add(np.flatnonzero(rank_at >= 0))
    odd = []  # words where a merge made a pair of lower rank than its own
    while queue:
        band = heapq.heappop(queue)
        here = np.concatenate(index.pop(band))
        here = here[rank_at[here] >> BAND_BITS == band]
        if not len(here):
            continue
        here = _distinct(here)
        # each word's lowest rank first; words do not touch each other
        ranks, own = rank_at[here], word[here]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        least = np.minimum.reduceat(ranks, heads)
        first = ranks == np.repeat(least, np.diff(np.append(heads, len(here))))
        later, i = here[~first], here[first]
        if len(later):
            index[band] = [later]
            heapq.heappush(queue, band)
        # of pairs that overlap (x x x) every other one joins, from the left
        chain = np.append(False, i[1:] == nxt[i[:-1]])
        if chain.any():
            order = np.arange(len(i))
            i = i[(order - np.maximum.accumulate(np.where(chain, 0, order))) % 2 == 0]
        rank = rank_at[i]
        j = nxt[i]
        k = nxt[j]
        sym[i] = table.made[rank]
        sym[j] = -1
        rank_at[j] = -1
        nxt[i] = k
        inner = k >= 0
        prv[k[inner]] = i[inner]
        rank_at[i] = -1
        # only the two pairs beside a merge change
        left = prv[i]
        before = left >= 0
        touched = _distinct(np.concatenate([i[inner], left[before]]))
        rank_at[touched] = table.rank(sym[touched], sym[nxt[touched]])
        for who, by in ((i[inner], rank[inner]), (left[before], rank[before])):
            low = (rank_at[who] >= 0) & (rank_at[who] <= by)
            if low.any():
                odd.append(word[who[low]])
        touched = touched[rank_at[touched] >= 0]
        if len(touched):
            add(touched)
    if odd:
        begins = ends - lengths
        for w in np.unique(np.concatenate(odd)).tolist():
            own = start_sym[begins[w]:ends[w]].tolist()
            got = _word(table, own)
            sym[begins[w]:ends[w]] = got + [-1] * (len(own) - len(got))
    live = sym >= 0
    counts = np.concatenate([[0], np.cumsum(live)])
    return sym[live], np.concatenate([[0], counts[ends]])


def _distinct(positions: np.ndarray) -> np.ndarray:
    positions = np.sort(positions)
    return positions[np.append(True, positions[1:] != positions[:-1])] if len(positions) else positions


def _word(table: MergeTable, sym: list[int]) -> list[int]:
    """One word by its definition: always join the leftmost pair of least rank."""
    while len(sym) > 1:
        ranks = [table.pairs.get(a << ID_BITS | b, 1 << 60) for a, b in zip(sym, sym[1:])]
        i = ranks.index(min(ranks))
        if ranks[i] == 1 << 60:
            break
        sym = sym[:i] + [int(table.made[ranks[i]])] + sym[i + 2:]
    return sym
