"""Weighted acyclic automata over words: n-gram counts as transducers.

A transducer reads a phrase of one to ``MOST`` words and gives its count. Its
labels index a sorted list of words, so sorted phrases are sorted label rows.
``build`` makes the states from sorted rows front to back: rows that agree in
their first words share those states, and states with one outgoing transition
(most of them) are shared wherever label and weight agree. ``union`` merges
any number of transducers and sums weights; ``compose`` reads a sorted list of
phrases through one.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: words of the longest phrase
MOST = 3
_DTYPES = (np.uint8, np.uint16, np.uint32, np.int64)


class Grams:
    """Sorted distinct label rows with weights. ``words``: sorted binary array;
    ``labels``: one column per word of a phrase, 0 where it has ended, else the
    word's index plus one."""

    def __init__(self, words: pa.Array, labels: np.ndarray, weights: np.ndarray):
        self.words, self.labels, self.weights = words, labels, weights

    def __len__(self) -> int:
        return len(self.weights)


def sort_and_sum(labels: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Label rows in order, each once, with the sum of its weights."""
    if not len(weights):
        return labels, weights
    bits = max(1, int(size).bit_length())
    if bits * labels.shape[1] <= 63:
        key = labels[:, 0].astype(np.int64)
        for k in range(1, labels.shape[1]):
            key = key << bits | labels[:, k]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    else:
        order = np.lexsort(labels.T[::-1])
        rows = labels[order]
        first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return labels[order[first]], np.add.reduceat(weights[order], first)


def union(parts: Iterable[Grams]) -> Grams:
    """All phrases of the parts, weights summed."""
    parts = [p for p in parts if len(p)]
    if len(parts) < 2:
        return parts[0] if parts else Grams(pa.array([], pa.binary()), np.empty((0, MOST), np.int32), np.empty(0, np.int64))
    coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int32)
    rank[0], rank[order + 1] = 0, np.arange(1, len(order) + 1)
    place, rows = coded.indices.to_numpy(), []
    at = 0
    for p in parts:  # a part's order stays: both word lists are sorted
        own = rank[np.append(-1, place[at:at + len(p.words)]) + 1]
        rows.append(own[p.labels])
        at += len(p.words)
    labels, weights = sort_and_sum(np.concatenate(rows), np.concatenate([p.weights for p in parts]), len(order) + 1)
    return Grams(coded.dictionary.take(pa.array(order)), labels, weights)


def _changes(*cols: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cols[0]), bool)
    out[:1] = True
    for c in cols:
        out[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(out)


class Transducer:
    """Transitions state by state. Depth 0: ``label0`` with ``fan0`` transitions
    in the state it leads to; those are ``label1`` with the index of their last
    state; state s has ``fan2[s]`` transitions, ``label2`` with their weight."""

    FIELDS = ("label0", "fan0", "label1", "state1", "fan2", "label2", "weight")

    def __init__(self, words: pa.Array, *fields: np.ndarray):
        self.words = words
        for name, value in zip(self.FIELDS, fields):
            setattr(self, name, value)

    @staticmethod
    def build(grams: Grams) -> "Transducer":
        a, b, c = grams.labels.T
        first1 = _changes(a, b)
        first0 = np.flatnonzero(np.isin(first1, _changes(a), assume_unique=True))
        fan1 = np.diff(np.append(first1, len(a)))
        # the register: last states with one transition, by its label and weight
        lone = first1[fan1 == 1]
        known, which = np.unique(np.stack([c[lone], grams.weights[lone]]), axis=1, return_inverse=True) if len(lone) else (np.empty((2, 0), np.int64), lone)
        state = np.empty(len(first1), np.int64)
        state[fan1 == 1] = which.reshape(-1)
        wide = np.flatnonzero(fan1 > 1)
        state[wide] = known.shape[1] + np.arange(len(wide))
        rest = np.repeat(fan1 > 1, fan1)
        return Transducer(grams.words, a[first1[first0]], np.diff(np.append(first0, len(first1))), b[first1], state,
                          np.append(np.ones(known.shape[1], np.int64), fan1[wide]), np.append(known[0], c[rest]),
                          np.append(known[1], grams.weights[rest]))

    def grams(self) -> Grams:
        """All phrases in order."""
        begin = np.cumsum(self.fan2) - self.fan2
        fan = self.fan2[self.state1]
        last = np.repeat(begin[self.state1] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
        a = np.repeat(np.repeat(self.label0, self.fan0), fan)
        labels = np.stack([a, np.repeat(self.label1, fan), self.label2[last]], axis=1).astype(np.int32)
        return Grams(self.words, labels, self.weight[last].astype(np.int64))

    def to_bytes(self) -> bytes:
        text = pa.chunked_array([self.words.cast(pa.large_binary())]).combine_chunks()
        lengths = pc.binary_length(text).to_numpy().astype(np.int64) if len(text) else np.empty(0, np.int64)
        out = []
        for values in (lengths, *(getattr(self, f) for f in self.FIELDS)):
            top = int(values.max()) if len(values) else 0
            code = next(k for k, t in enumerate(_DTYPES) if top <= np.iinfo(t).max)
            out += [bytes([code]), len(values).to_bytes(8, "little"), values.astype(_DTYPES[code]).tobytes()]
        return b"".join([*out, *text.to_pylist()])

    @staticmethod
    def from_bytes(data: bytes) -> "Transducer":
        at, fields = 0, []
        for _ in range(1 + len(Transducer.FIELDS)):
            kind, n = np.dtype(_DTYPES[data[at]]), int.from_bytes(data[at + 1:at + 9], "little")
            fields.append(np.frombuffer(data, kind, n, at + 9).astype(np.int64))
            at += 9 + n * kind.itemsize
        offs = np.append(0, np.cumsum(fields[0])).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(fields[0]), [None, pa.py_buffer(offs), pa.py_buffer(data[at:])])
        return Transducer(words, *fields[1:])


def part(grams: Grams, rows: np.ndarray) -> Grams:
    """Some rows (ascending) of ``grams``, with only the words they use."""
    labels = grams.labels[rows]
    used = np.unique(labels)
    used = used[used > 0]
    back = np.zeros(len(grams.words) + 1, np.int32)
    back[used] = np.arange(1, len(used) + 1)
    return Grams(grams.words.take(pa.array(used - 1)), back[labels], grams.weights[rows])


def of_phrases(phrases: pa.Array, weights: np.ndarray) -> Grams:
    """Space-joined phrases of up to ``MOST`` words, each once, with weights."""
    split = pc.split_pattern(phrases.cast(pa.string()), " ")
    fan = pc.list_value_length(split).to_numpy().astype(np.int64)
    coded = split.flatten().cast(pa.binary()).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(1, len(order) + 1)
    labels = np.zeros((len(fan), MOST), np.int32)
    at = np.repeat(np.arange(len(fan)), fan)
    labels[at, np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)] = rank[coded.indices.to_numpy()]
    labels, weights = sort_and_sum(labels, weights, len(order) + 1)
    return Grams(coded.dictionary.take(pa.array(order)), labels, weights)


def compose(phrases: pa.Array, counts: Transducer) -> np.ndarray:
    """Count of each phrase, 0 where the transducer does not accept it. All
    phrases are read together, a word at a time, each from its own state."""
    split = pc.split_pattern(phrases.cast(pa.string()), " ")
    fan = pc.list_value_length(split).to_numpy().astype(np.int64)
    flat = split.flatten().cast(pa.binary())
    found = pc.index_in(flat, counts.words).fill_null(-2).to_numpy().astype(np.int64) + 1  # -1: no label
    labels = np.zeros((len(fan), MOST), np.int64)
    labels[np.repeat(np.arange(len(fan)), fan), np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)] = found
    size = len(counts.words) + 1
    # transitions in order of (state, label); a label that is none meets none
    in1 = np.repeat(np.arange(len(counts.label0)), counts.fan0) * size + counts.label1
    in2 = np.repeat(np.arange(len(counts.fan2)), counts.fan2) * size + counts.label2
    out = np.zeros(len(fan), np.int64)
    live = np.flatnonzero((labels >= 0).all(axis=1))
    state = _step(counts.label0, labels[live, 0])
    live, state = live[state >= 0], state[state >= 0]
    state = _step(in1, state * size + labels[live, 1])
    live, state = live[state >= 0], counts.state1[state[state >= 0]]
    state = _step(in2, state * size + labels[live, 2])
    out[live[state >= 0]] = counts.weight[state[state >= 0]]
    return out


def _step(transitions: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted transition, -1 where there is none."""
    if not len(transitions):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(transitions, wanted), len(transitions) - 1)
    return np.where(transitions[at] == wanted, at, -1)
