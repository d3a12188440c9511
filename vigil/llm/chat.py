"""Chat formatting in budgeted windows.

A conversation becomes one row with an array of windows. Prefix sums of its
turns' tokens choose spans of whole turns: a window holds the system turn, a
limited history of turns that an earlier window has already shown, and new
turns as far as the budget goes. The loss covers the assistant texts of new
turns only, so each is a target once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import bounded_batches

BEGIN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: control strings that a text may not bear unescaped (fixed values)
CONTROL = [BEGIN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(f"{re.escape(BEGIN)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}\n", re.S)
TARGET = "assistant"
SYSTEM = "system"
WINDOW_TOKENS = 1024
HISTORY_TOKENS = 256

WINDOWS = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("loss_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)]), False), False),
    T.StructField("n_repeated", T.IntegerType(), False),
    T.StructField("n_tokens", T.IntegerType(), False)]), False)


def escape(text: str) -> str:
    """Double each backslash and break each control string with one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@lru_cache(maxsize=1)
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def spans(tokens: np.ndarray, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(first shown, first new, end) of each window over turns of so many
    tokens. A turn over the budget has a window of its own, without history."""
    total = np.concatenate([[0], np.cumsum(tokens)])
    out, new = [], 0
    while new < len(tokens):
        shown = int(np.searchsorted(total, total[new] - history))
        end = int(np.searchsorted(total, total[shown] + budget, side="right")) - 1
        if end <= new:
            shown = new
            end = max(new + 1, int(np.searchsorted(total, total[new] + budget, side="right")) - 1)
        out.append((shown, new, end))
        new = end
    return out


def windows(turns: list[tuple[str, str]], count, budget: int, history: int) -> list[dict]:
    marked = [f"{BEGIN}{escape(r)}{SEP}{escape(t)}{END}\n" for r, t in turns]
    tokens = np.array([count(m) for m in marked], np.int64)
    head = 1 if turns and turns[0][0] == SYSTEM else 0
    body = range(head, len(turns))
    fixed = int(tokens[:head].sum())
    chosen = spans(tokens[head:], max(1, budget - fixed), history) or [(0, 0, 0)]
    out = []
    for k, (shown, new, end) in enumerate(chosen):
        text, loss = "", []
        for i in [*range(head), *body[shown:end]]:
            role, said = turns[i]
            if role == TARGET and i >= head + new:
                at = len(text) + len(BEGIN) + len(escape(role)) + len(SEP)
                loss.append({"start": at, "end": at + len(escape(said))})
            text += marked[i]
        out.append({"text": text, "loss_spans": loss, "n_repeated": (head if k else 0) + new - shown,
                    "n_tokens": fixed + int(tokens[head:][shown:end].sum())})
    return out


def format_windows(df: DataFrame, budget: int = WINDOW_TOKENS, history: int = HISTORY_TOKENS,
                   ranks_path: str | None = None) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) -> conv_id, windows.

    Null roles and texts are empty. Turns of a conversation are ordered by
    turn, then role and text, so ties and repeated rows have a defined place.
    Rows of a null conv_id are one conversation. Other columns are not kept. A
    conversation is one row, so its turns are gathered in one task by nature.
    """
    path = ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bounded_batches(df.sparkSession)
    gathered = (df.select("conv_id", F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                              F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))
                .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    out = T.StructType([df.schema["conv_id"], T.StructField("windows", WINDOWS, False)])

    def task(batches):
        encoding = _encoding(path)
        count = lambda s: len(encoding.encode_ordinary(s))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                made = [windows([(t["role"], t["text"]) for t in turns], count, budget, history)
                        for turns in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, _arrow(WINDOWS))], names=out.names)

    return gathered.mapInArrow(task, out)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def read_back(made: list[dict]) -> tuple[list[tuple[str, str]], str]:
    """The turns and the text under the loss mask, from the output alone."""
    turns, loss = [], []
    for w in made:
        seen = [(unescape(r), unescape(t)) for r, t in _TURN.findall(w["text"])]
        # repeated turns stand first
        turns += seen[w["n_repeated"]:]
        loss += [unescape(w["text"][s["start"]:s["end"]]) for s in w["loss_spans"]]
    return turns, "".join(loss)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and what ``read_back`` finds in its windows: turns, their hash,
    the code points and hash of the loss text, and all characters written."""
    out = T.StructType([formatted.schema["conv_id"], T.StructField("n_turns", T.LongType(), False),
                        T.StructField("turns_sha256", T.StringType(), False),
                        T.StructField("loss_chars", T.LongType(), False),
                        T.StructField("loss_sha256", T.StringType(), False),
                        T.StructField("formatted_chars", T.LongType(), False),
                        T.StructField("n_windows", T.LongType(), False)])

    def task(batches):
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for made in batch.column(1).to_pylist():
                turns, loss = read_back(made)
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                             sum(len(w["text"]) for w in made), len(made)))
            cols = list(zip(*rows)) if rows else [[] for _ in range(6)]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=out.names)

    return formatted.select("conv_id", "windows").mapInArrow(task, out)
