"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (one to three characters,
with the blanks beside a word) of a language by rank. A text is ranked the
same way, and the language whose profile is least out of place wins: the sum,
over the text's n-grams, of the difference of ranks, or of the profile's
length where the profile lacks the n-gram.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import pretokens as pt
from vigil.llm.common import bounded_batches, others, schema_of

#: ranks in a profile
PROFILE = 300
UNKNOWN = "und"
#: languages that may be learned; the profiles of all go to every task
MAX_LANGUAGES = 1000
#: bytes of text that are ranked together
BLOCK_BYTES = 1 << 20
NONE, BLANK, FIRST = 0, 1, 2
_BITS = 21  # of a code point in a packed n-gram


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Lower case of each code point that has one of one character."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def ngrams(cps: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of a block of texts: row of each, its three symbols as one
    number in base ``len(alphabet) + FIRST``, and the sorted alphabet; last,
    the rows that have a letter. ``rows``: first code point of each text, and
    the end."""
    cls = pt.classes()[cps]
    at = np.flatnonzero(cls == pt.LETTER)
    row = np.searchsorted(rows, at, side="right") - 1
    letters = _lower()[cps[at]]
    n = len(at)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, none
    present = np.zeros(0x110000, bool)
    present[letters] = True
    alphabet = np.flatnonzero(present)
    sym = np.searchsorted(alphabet, letters) + FIRST
    base = len(alphabet) + FIRST
    begins = np.ones(n, bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    ends = np.append(begins[1:], True)
    before = np.where(begins, BLANK, np.append(0, sym[:-1]))
    after = np.where(ends, BLANK, np.append(sym[1:], 0))
    pair_before = before * base + sym           # (blank or letter, letter)
    pair_end = sym[ends] * base + BLANK         # (letter, blank)
    inner = ~(begins & ends)                    # (x, letter, y) but for (blank, letter, blank)
    keys = np.concatenate([sym, pair_before, pair_end, (pair_before * base + after)[inner]])
    which = np.concatenate([row, row, row[ends], row[inner]])
    return which, keys, alphabet, row[np.append(True, row[1:] != row[:-1])]


def counts(group: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, key, count) of the distinct pairs, sorted by both."""
    span = int(keys.max()) + 1
    if (int(group.max()) + 1) * span >= 1 << 62:  # a very large alphabet: number the keys first
        kinds, numbers = np.unique(keys, return_inverse=True)
        group, numbers, n = counts(group, numbers)
        return group, kinds[numbers], n
    both = np.sort(group * span + keys)
    heads = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    return both[heads] // span, both[heads] % span, np.diff(np.append(heads, len(both)))


def pack(keys: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """N-grams as three code points of 21 bits each, 0 for none, 32 for a blank."""
    symbols = np.concatenate([[0, 32], alphabet]).astype(np.int64)
    base = len(symbols)
    return ((symbols[keys // base ** 2] << 2 * _BITS) | (symbols[keys // base % base] << _BITS) | symbols[keys % base])


def unpack(packed: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """The inverse of ``pack``, -1 where the alphabet lacks a character."""
    symbols = np.concatenate([[0, 32], alphabet]).astype(np.int64)
    order = np.argsort(symbols)
    out, missing = np.zeros(len(packed), np.int64), np.zeros(len(packed), bool)
    for k in (2, 1, 0):
        c = (packed >> k * _BITS) & ((1 << _BITS) - 1)
        at = order[np.minimum(np.searchsorted(symbols, c, sorter=order), len(symbols) - 1)]
        missing |= symbols[at] != c
        out = out * len(symbols) + at
    return np.where(missing, -1, out)


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """Profiles (lang, ngram, rank) of all rows with a language and a text.

    N-grams are packed code points. Ties in count go to the smaller n-gram.
    Every task counts its own rows, so only distinct n-grams are shuffled.
    """
    bounded_batches(df.sparkSession)
    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("ngram", T.LongType()),
                        T.StructField("n", T.LongType())])

    def task(batches):
        known: list[str] = []
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            for name in names.dictionary.to_pylist():
                if name not in known:
                    known.append(name)
            lang = np.array([known.index(x) for x in names.dictionary.to_pylist()], np.int64)[
                names.indices.to_numpy()]
            for i, _, data, offs in pt.blocks(batch.column(1), BLOCK_BYTES):
                if not data.size:
                    continue
                cps, _, rows = pt.code_points(data, offs)
                row, keys, alphabet, _ = ngrams(cps, rows)
                if not len(keys):
                    continue
                group, keys, n = counts(lang[i + row], keys)
                for g in np.unique(group).tolist():
                    own = group == g
                    old = sums.get(g, (np.empty(0, np.int64), np.empty(0, np.int64)))
                    kinds, at = np.unique(np.concatenate([old[0], pack(keys[own], alphabet)]), return_inverse=True)
                    sums[g] = kinds, np.bincount(at, np.concatenate([old[1], n[own]])).astype(np.int64)
        for g, (kinds, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([known[g]] * len(kinds), pa.string()), pa.array(kinds),
                                              pa.array(n)], names=out.names)

    rows = (df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
            .where("lang is not null and text is not null"))
    total = rows.mapInArrow(task, out).groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    # filtered as it is numbered, so every task passes on its first rows only
    return (total.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= size)
            .select("lang", "ngram", (F.col("rank") - 1).alias("rank")))


def predict(df: DataFrame, profiles: list[tuple[str, int, int]], text_col: str = "text",
            size: int = PROFILE, pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The other columns of ``df`` with the language of each whole text and a
    score from 0 to 1 (one less the mean share of the greatest distance).

    ``und`` and 0 where the text is null, empty or has no letter, or no profile
    was learned. Languages at the same distance: the first by name. A column
    that bears an output's name is replaced.
    """
    bounded_batches(df.sparkSession)
    kept = others(df, text_col, pred_col, score_col)
    out = schema_of(df.select(*kept), T.StructField(pred_col, T.StringType(), False),
                    T.StructField(score_col, T.DoubleType(), False))
    names = sorted({lang for lang, _, _ in profiles})
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MAX_LANGUAGES} profiles are sent to every task")
    ranked = {name: ([g for lang, g, _ in profiles if lang == name], [r for lang, _, r in profiles if lang == name])
              for name in names}

    def task(batches):
        table = [(np.array(g, np.int64), np.array(r, np.int64)) for g, r in ranked.values()]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lang = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            for i, j, data, offs in pt.blocks(texts, BLOCK_BYTES):
                if not data.size or not table:
                    continue
                cps, _, rows = pt.code_points(data, offs)
                row, keys, alphabet, lettered = ngrams(cps, rows)
                if not len(keys):
                    continue
                distance, most = _distances(row, keys, alphabet, table, j - i, size)
                best = distance.argmin(axis=0)[lettered]
                lang[i + lettered] = np.array(names, object)[best]
                score[i + lettered] = 1 - distance[best, lettered] / most[lettered]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=out.names)

    return df.select(*kept, F.col(text_col).cast("string")).mapInArrow(task, out)


def _distances(row, keys, alphabet, table, n_rows, size):
    """Out-of-place distance of each profile to each row, and the greatest
    distance that the row could have."""
    row, keys, n = counts(row, keys)
    order = np.lexsort((-n, row))  # stable: ties stay in the order of the n-grams
    row, keys = row[order], keys[order]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    rank = np.arange(len(row)) - np.repeat(heads, np.diff(np.append(heads, len(row))))
    top = rank < size
    row, keys, rank = row[top], keys[top], rank[top]
    distance = np.empty((len(table), n_rows))
    for k, (grams, ranks) in enumerate(table):
        own = unpack(grams, alphabet)
        have = own >= 0
        by_key = np.argsort(own[have])
        own, ranks = own[have][by_key], ranks[have][by_key]
        at = np.minimum(np.searchsorted(own, keys), max(len(own) - 1, 0))
        hit = own[at] == keys if len(own) else np.zeros(len(keys), bool)
        far = np.full(len(keys), size, np.int64)
        far[hit] = np.abs(rank[hit] - ranks[at[hit]])
        distance[k] = np.bincount(row, far, n_rows)
    return distance, size * np.maximum(np.bincount(row, minlength=n_rows), 1)
