"""Byte-level BPE encoding and decoding by a replay of the merges.

The distinct words of a block of texts form a small corpus; ``bpe.replay``
applies every merge to it in rank order through an inverted index. Texts are
then looked up word by word. Every task works on its own rows, nothing is
shuffled, and a task holds one block (a few MB of text) and a bounded table of
words it has already seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import pretokens as pt
from vigil.llm.bpe import MergeTable
from vigil.llm.common import bounded_batches, others, schema_of

RANKS = "byte_bpe_multi_50k.tiktoken"


def encode_texts(texts: pa.Array, words: pt.WordIds) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: first row, row after the last, all ids, and the offset
    of each row's ids (one more at the end)."""
    for i, j, data, offs in pt.blocks(texts):
        if not data.size:
            yield i, j, np.empty(0, np.int32), np.zeros(j - i + 1, np.int64)
            continue
        cps, at, rows = pt.code_points(data, offs)
        starts = pt.starts_with_spaces(cps, rows[:-1][rows[:-1] < len(cps)])
        which, kinds = pt.distinct(data, at[starts], data.size)
        ids, begin, length = words(kinds)
        flat, ends = pt.gather(ids, begin[which], length[which])
        yield i, j, flat, ends[np.searchsorted(starts, rows)]


def decode_ids(ids: np.ndarray, offs: np.ndarray, tokens: pa.Array) -> pa.Array:
    """Bytes of each row of ids: its tokens' bytes one after another."""
    parts = tokens.take(pa.array(ids))
    at = np.frombuffer(parts.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    data = parts.buffers()[2] or pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(at[offs].tobytes()), data])


def round_trip(df: DataFrame, text_col: str = "text", ids_col: str = "ids",
               bytes_col: str = "decoded", ranks_path: str | None = None) -> DataFrame:
    """The other columns of ``df`` with the ids of each whole text and the
    bytes that those ids decode to.

    A null or empty text has no ids and decodes to no bytes. Strings that look
    like special tokens are ordinary text. Repeated rows stay. A column that
    bears an output's name is replaced.
    """
    path = ranks_path or public_tokenizers.path(RANKS)
    bounded_batches(df.sparkSession)
    kept = others(df, text_col, ids_col, bytes_col)
    out = schema_of(df.select(*kept), T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False),
                    T.StructField(bytes_col, T.BinaryType(), False))

    def task(batches):
        words = pt.WordIds(MergeTable.from_ranks(path))
        tokens = pa.array(words.table.tokens, pa.large_binary())
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i, j, ids, offs in encode_texts(texts, words):
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids))
                back = decode_ids(ids, offs, tokens).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, j - i) for c in batch.columns[:-1]] + [lists, back], names=out.names)

    return df.select(*kept, F.col(text_col).cast("string")).mapInArrow(task, out)
