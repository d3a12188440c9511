"""Token counts by heap-and-linked-list byte-pair merging.

A word is a linked list of symbols. A heap holds the adjacent pairs that a
vocabulary merges, by (rank, place); the lowest pair is popped, its right
symbol leaves the list, and only the two pairs beside it are looked up and
pushed. A popped pair whose symbols have changed since is stale and skipped.
The count of a word is its initial symbols minus its merges: no identifiers of
a text are made.

Text is normalised and split as the vocabulary file says (NFC, white space
collapsed, lower case; contractions, letter runs, single numbers and other
runs), a block of texts at a time over code-point arrays; texts with characters
from U+0300 on are normalised and split by the library's own first two steps.
Counts of distinct words are kept in a table of bounded size for each task.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import pretokens as pt
from vigil.llm.bpe import byte_characters
from vigil.llm.common import bounded_batches, others, schema_of

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: distinct words whose counts a task keeps
WORDS = 200_000
#: below this code point NFC changes nothing, and lower case is one character
#: but for U+0130
SIMPLE = 0x300


class Vocabulary:
    """first/last: symbol of each byte inside a word and as its last byte;
    pairs: (left, right) -> (rank, joined symbol); special: strings that the
    library takes whole out of a text."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.first = [vocab[c] for c in chars]
        self.last = [vocab[c + end] for c in chars]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    @staticmethod
    @lru_cache(maxsize=2)
    def load(path: str) -> "Vocabulary":
        return Vocabulary(path)


def merges(word: bytes, vocab: Vocabulary) -> int:
    """Merges that the word takes: its pairs in a heap by (rank, place)."""
    n = len(word)
    if n < 2:
        return 0
    sym = [vocab.first[b] for b in word]
    sym[-1] = vocab.last[word[-1]]
    pairs = vocab.pairs
    heap = []
    for i in range(n - 1):
        found = pairs.get((sym[i], sym[i + 1]))
        if found:
            heap.append((found[0], i, found[1], sym[i], sym[i + 1]))
    heapq.heapify(heap)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    done = 0
    while heap:
        _, i, made, a, b = heapq.heappop(heap)
        j = right[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue  # stale: one of its symbols has been merged since
        done += 1
        sym[i], sym[j] = made, -1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            found = pairs.get((made, sym[k]))
            if found:
                heapq.heappush(heap, (found[0], i, found[1], made, sym[k]))
        h = left[i]
        if h >= 0:
            found = pairs.get((sym[h], made))
            if found:
                heapq.heappush(heap, (found[0], h, found[1], sym[h], made))
    return done


class Counts:
    """Tokens of distinct words; at most ``most`` words are kept."""

    def __init__(self, vocab: Vocabulary, most: int = WORDS):
        self.vocab, self.most, self.known = vocab, most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words), np.int64)
        known = self.known
        for k, word in enumerate(words):
            n = known.get(word)
            if n is None:
                n = len(word) - merges(word, self.vocab)
                if len(known) < self.most:
                    known[word] = n
            out[k] = n
        return out


@lru_cache(maxsize=1)
def _library(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


def _hard_words(text: str, path: str) -> list[bytes]:
    """Words of a text with characters whose normal form or class may depend on
    the library's Unicode tables: its own normaliser and splitter give them."""
    tok, byte_of = _library(path), _byte_of()
    pieces = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text))
    return [bytes(byte_of[c] for c in piece) for piece, _ in pieces]


def _count_simple(texts: pa.Array, counts: Counts) -> np.ndarray:
    """Tokens of each text of simple characters, block by block."""
    out = np.zeros(len(texts), np.int64)
    for i, j, data, offs in pt.blocks(texts):
        if not data.size:
            continue
        lower = str(data, "utf-8").lower()  # character by character: as many as before
        cps = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
        rows = pt.code_points(data, offs)[2]
        at = np.zeros(len(cps) + 1, np.int64)
        np.cumsum(1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800), out=at[1:])
        starts, inked = pt.starts_of_words(cps, rows[:-1][rows[:-1] < len(cps)])
        starts, ends = starts[inked], np.append(starts[1:], len(cps))[inked]
        flat = lower.encode()
        which, kinds = _distinct(flat, at[starts], at[ends])
        row = np.searchsorted(rows, starts, side="right") - 1
        out[i:j] = np.bincount(row, weights=counts(kinds)[which], minlength=j - i).astype(np.int64)
    return out


def _distinct(data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Index of each word into the distinct ones, and those: the gaps between
    words are pieces too, and are left out."""
    cuts = np.unique(np.concatenate([[0], begin, end, [len(data)]]))
    which, kinds = pt.distinct(pa.py_buffer(data), cuts[:-1], len(data))
    own = which[np.searchsorted(cuts[:-1], begin)]
    used, back = np.unique(own, return_inverse=True)
    return back, [kinds[k] for k in used.tolist()]


def count_texts(texts: pa.Array, counts: Counts) -> np.ndarray:
    """Tokens of each whole text. A special string counts as one token; the
    texts beside it are counted by themselves."""
    texts = texts.cast(pa.large_string()).fill_null("")
    vocab = counts.vocab
    simple = np.ones(len(texts), bool)
    for i, j, data, offs in pt.blocks(texts):
        raw = np.frombuffer(data, np.uint8)
        # lead bytes 0xCC and up start U+0300 and up; 0xC4 0xB0 is U+0130
        hard = np.flatnonzero(raw >= 0xCC)
        dotted = np.flatnonzero((raw[:-1] == 0xC4) & (raw[1:] == 0xB0)) if len(raw) > 1 else hard[:0]
        simple[i + np.searchsorted(offs, np.concatenate([hard, dotted]), side="right") - 1] = False
    special = np.zeros(len(texts), bool)
    for s in vocab.special:
        special |= np.asarray(pc.match_substring(texts, s))
    out = np.zeros(len(texts), np.int64)
    at = np.flatnonzero(simple & ~special)
    if len(at):
        out[at] = _count_simple(texts.take(pa.array(at)), counts)
    for k in np.flatnonzero(~simple | special).tolist():
        text = texts[k].as_py()
        parts = vocab.cut.split(text) if special[k] else [text]
        out[k] = len(parts) - 1 + sum(int(counts(_hard_words(part, vocab.path)).sum()) for part in parts if part)
    return out


def count_tokens(df: DataFrame, text_col: str = "text", limit: int = LIMIT, vocabulary: str | None = None) -> DataFrame:
    """The other columns of ``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens) of each whole text.

    No begin or end token is added; special strings inside a text are one
    token each, as the library takes them. Null and empty texts have no token.
    Repeated rows are counted each; an empty table gives an empty table. Very
    long texts stand alone in a block and are counted whole. Columns that bear
    an output's name are replaced; all others are kept, whatever their names.
    ``vocabulary``: path of a file that every executor can read."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    bounded_batches(df.sparkSession)
    kept = others(df, text_col, "n_bytes", "n_tokens", "over_limit")
    out = schema_of(df.select(*kept), T.StructField("n_bytes", T.LongType(), False),
                    T.StructField("n_tokens", T.LongType(), False), T.StructField("over_limit", T.BooleanType(), False))

    def task(batches):
        counts = Counts(Vocabulary.load(path))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n = count_texts(texts, counts)
            size = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], size, pa.array(n), pa.array(n > limit)], names=out.names)

    # neutral names, so that no column meets that of the text
    cols = [F.col(c).alias(f"c{k}") for k, c in enumerate(kept)]
    return df.select(*cols, F.col(text_col).cast("string").alias("text")).mapInArrow(task, out)
