"""Cost-balanced packing of token pieces into sequences.

``pieces`` tokenizes whole texts and cuts them into pieces of at most one
sequence; ``pack`` deals the pieces out by hash to shards of a bounded size
and packs each shard by itself: pieces in descending length go to the sequence
of least estimated cost (linear plus quadratic in each piece's length, as
attention costs inside a piece) that still has room. All shards run in
parallel; with thousands of pieces in each, what the last sequences of a shard
leave empty is a small share.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import pretokens as pt
from vigil.llm.bpe import MergeTable
from vigil.llm.common import bounded_batches, others, schema_of, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 2048
#: expected pieces in a shard; one task packs a shard
SHARD_PIECES = 20_000
#: below this code point NFC changes nothing and lower case is one character,
#: but for U+0130
SIMPLE = 0x300


@lru_cache(maxsize=1)
def _library(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def _simple_ids(texts: pa.Array, words: pt.WordIds):
    """Ids of texts of simple characters only, block by block."""
    for i, j, data, offs in pt.blocks(texts):
        if not data.size:
            yield i, j, np.empty(0, np.int32), np.zeros(j - i + 1, np.int64)
            continue
        cps, _, rows = pt.code_points(data, offs)
        lower = str(data, "utf-8").lower().encode()
        cps = np.frombuffer(lower.decode().encode("utf-32-le"), np.uint32)
        at = np.zeros(len(cps) + 1, np.int64)
        np.cumsum(1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800), out=at[1:])
        starts, inked = pt.starts_of_words(cps, rows[:-1][rows[:-1] < len(cps)])
        which, kinds = pt.distinct(pa.py_buffer(lower), at[starts], len(lower))
        blank = np.zeros(len(kinds), bool)
        blank[which[~inked]] = True
        solid = np.flatnonzero(~blank)
        ids, b, n = words([kinds[k] for k in solid.tolist()])
        begin, length = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        begin[solid], length[solid] = b, n
        flat, ends = pt.gather(ids, begin[which], length[which])
        yield i, j, flat, ends[np.searchsorted(starts, rows)]


def text_ids(texts: pa.Array, words: pt.WordIds, path: str) -> list[np.ndarray]:
    """The vocabulary's ids of each whole text, without special tokens. Texts
    of simple characters are looked up word by word after a replay of the
    merges; any other text goes to the tokenizers library itself."""
    texts = texts.cast(pa.large_string()).fill_null("")
    out: list[np.ndarray | None] = [None] * len(texts)
    simple = np.ones(len(texts), bool)
    for i, j, data, offs in pt.blocks(texts):
        raw = np.frombuffer(data, np.uint8)
        # lead bytes 0xCC and up start U+0300 and up; 0xC4 0xB0 is U+0130
        hard = np.flatnonzero(raw >= 0xCC)
        dotted = np.flatnonzero((raw[:-1] == 0xC4) & (raw[1:] == 0xB0)) if len(raw) > 1 else hard[:0]
        simple[i + np.searchsorted(offs, np.concatenate([hard, dotted]), side="right") - 1] = False
    where = np.flatnonzero(simple)
    for i, j, ids, offs in _simple_ids(texts.take(pa.array(where)), words):
        for k in range(i, j):
            out[where[k]] = ids[offs[k - i]:offs[k - i + 1]]
    rest = np.flatnonzero(~simple).tolist()
    for k in rest:
        out[k] = np.array(_library(path).encode(texts[k].as_py(), add_special_tokens=False).ids, np.int32)
    return out


def pieces(df: DataFrame, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of each text: the other columns, ``start`` (ids of
    its text before it), ``length``, ``ids_crc32`` (little-endian unsigned 32-bit
    ids), ``doc_tokens``, and with ``with_ids`` the ids themselves.

    A text is its ids and ``end_id``; a null or empty one is that id alone.
    Pieces are full sequences from the front and one remainder, so a text of up
    to ``capacity`` tokens stays whole. Repeated rows give repeated pieces. A
    column that bears an output's name is replaced.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    bounded_batches(df.sparkSession)
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    kept = others(df, text_col, "ids", *names)
    fields = [T.StructField(n, T.LongType(), False) for n in names]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    out = schema_of(df.select(*kept), *fields)

    def task(batches):
        words = pt.WordIds(MergeTable.from_word_end_json(path))
        for batch in batches:
            rows, found, parts = [], {n: [] for n in names}, []
            for k, ids in enumerate(text_ids(batch.column(batch.num_columns - 1), words, path)):
                ids = np.append(ids, np.int32(end_id)).astype("<i4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append(k)
                    for n, v in zip(names, (start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        found[n].append(v)
                    if with_ids:
                        parts.append(piece)
            arrays = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
            arrays += [pa.array(found[n], pa.int64()) for n in names]
            if with_ids:
                arrays.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return df.select(*kept, F.col(text_col).cast("string")).mapInArrow(task, out)


def piece_cost(length, capacity: int = CAPACITY):
    """Estimated cost of a piece: its tokens and, weighed to the same size at
    a full sequence, the token pairs that attention inside it visits."""
    return length + length * (length / capacity)


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``lengths`` descend."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int(np.searchsorted(-lengths, -capacity, side="right"))
    seq[:full] = np.arange(full)
    rest = lengths[full:]
    n = max(1, -(-int(rest.sum()) // capacity))
    room = np.full(n, capacity, np.int64)
    cost = np.zeros(n)
    for i, length in enumerate(rest.tolist(), full):
        fits = np.where(room >= length, cost, np.inf)
        at = int(fits.argmin())
        if fits[at] == np.inf:
            at = len(room)
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
        seq[i], off[i] = full + at, capacity - room[at]
        room[at] -= length
        cost[at] += piece_cost(length, capacity)
    return seq, off


def pack(found: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with
    ``sequence_id`` and ``offset``. Every piece gets one place, places in a
    sequence follow each other from 0. Equal pieces may swap places. An empty
    table gives an empty table. Columns that bear an output's name are replaced."""
    keys = others(found, "sequence_id", "offset")
    # numbered before they are written, so that equal pieces spread over all shards
    found = written(found.select(*keys).withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-found.count() // shard_pieces))
    out = schema_of(found.select(*keys), T.StructField("sequence_id", T.LongType(), False),
                    T.StructField("offset", T.LongType(), False))

    def place(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_shard").sort_values("length", ascending=False, kind="stable", ignore_index=True)
        seq, rows["offset"] = assign(rows["length"].to_numpy(np.int64), capacity)
        rows["sequence_id"] = (int(shard[0]) << 32) + seq
        return rows[out.names]

    salt = [F.col(c) for c in keys if isinstance(found.schema[c].dataType, T.AtomicType)]
    dealt = found.withColumn("_shard", F.pmod(F.xxhash64(*salt, "_piece"), F.lit(shards))).drop("_piece")
    return dealt.groupBy("_shard").applyInPandas(place, out)
