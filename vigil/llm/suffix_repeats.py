"""Exact removal of byte strings that repeat anywhere in the corpus.

Every 400-byte string that starts at two or more places is removed wherever it
lies. A suffix array of all bytes would show such places as neighbours with a
common prefix of 400 or more; sorting a tuple for every byte externally writes
many times the input, so the order of all suffixes is induced from few, as
induced sorting does, and only as far as 400 bytes:

1. Sample. Of the 64-byte strings inside each 400-byte window the one with the
   least hash is the window's anchor. Equal windows have equal anchors at the
   same place, and neighbouring windows mostly share one, so about one position
   in 170 is an anchor with a range of windows.
2. Rank the sample. Windows whose anchor string is unique are unique. Ranges
   with equal anchor strings are grouped and compared whole; where two ranges
   are the same, all their windows repeat.
3. Induce the rest. Of ranges that differ, one of each kind is kept with its
   bytes, and its windows are compared one by one with those of the other kinds
   of the same anchor: in sorted runs where an anchor has up to ``RUN`` kinds,
   else by a distributed count of window digests.

The sorts, runs and counts are Spark's external ones; a task holds one text,
or one run. No step gathers an anchor's occurrences in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import bounded_batches, others, schema_of, written

LENGTH = 400
ANCHOR = 64
#: kinds of ranges of one anchor that are compared in memory
RUN = 2048
#: window starts of a long text that are handled at once
SEGMENT = 1 << 20
#: a filter of hashes, one bit each, that goes to every task: 8 MB at any size;
#: a wrong hit adds rows to later steps and changes no result
FILTER_BITS = 26
_POSITION = 0xFFFFFF
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64, for i up to n."""
    up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def rolling(raw: np.ndarray, size: int, base: int = _BASES[0]) -> np.ndarray:
    """A 64-bit hash of each string of ``size`` bytes."""
    n = len(raw)
    if base not in _CACHE or len(_CACHE[base][0]) <= n:
        _CACHE[base] = _powers(base, max(n, 1 << 16))
    up, down = _CACHE[base]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * up[:n], out=sums[1:])
    return _mix((sums[size:] - sums[:-size]) * down[:n - size + 1])


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbours: running minima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max)
    padded[:n] = values
    rows = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - size + 1], ahead[size - 1:n])


def anchors(raw: np.ndarray, length: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window start, last one, anchor's place, anchor's hash) of the
    ranges of windows that share an anchor, segment by segment."""
    for base in range(0, len(raw) - length + 1, SEGMENT):
        part = raw[base:base + SEGMENT + length - 1]
        hashes = rolling(part, anchor)
        # ties go to the first place, so equal windows agree
        packed = (hashes & np.uint64(~_POSITION & (2**64 - 1))) | np.arange(len(hashes), dtype=np.uint64)
        least = _window_min(packed, length - anchor + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        at = (least[first] & np.uint64(_POSITION)).astype(np.int64)
        last = np.append(first[1:], len(least)) - 1
        yield base + first, base + last, base + at, hashes[at].view(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Buffer]]:
    """Order, row hash and bytes of each text; columns _ord, _row, _text."""
    for order, row, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2).cast(pa.large_binary())):
        yield order, row, text.as_buffer()


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _filter(hashes: DataFrame, col: str):
    """Broadcast bits of a column of hashes; 2**FILTER_BITS / 64 words at most."""
    low = F.col(col).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.array(*[F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)])
    words = (hashes.select(F.shiftright(low, 6).alias("w"), F.get(bit, low.bitwiseAND(F.lit(63)).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b"))).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _place(row, first):
    """Hash of a range's place, the same in Spark and numpy (wrapping)."""
    x = np.uint64(row & (2**64 - 1)) ^ (first.astype(np.uint64) * np.uint64(_BASES[1]))
    return _mix(x).view(np.int64)


def repeated_spans(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, run: int = RUN,
                   keep_first: bool = False) -> DataFrame:
    """(_row, start, end) byte spans whose strings of ``length`` bytes repeat;
    they may overlap. ``texts``: _ord (a long), _row (a long that equal rows
    share) and _text. With ``keep_first`` the first place of each string, by
    (_ord, _row, start), is not among the spans: every kind of range keeps its
    first place, and of the kinds that share a window only the first one's is
    spared, so exactly one place of each window is."""
    spark = texts.sparkSession
    texts = texts.select("_ord", "_row", "_text")
    span_type = "_row long, start long, end long"

    def count(batches):
        for batch in batches:
            found = [h for *_, text in _texts(batch) for *_, h in anchors(np.frombuffer(text, np.uint8), length, anchor)]
            kinds, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], names=["anchor", "n"])

    again = texts.mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    repeats = _filter(again, "anchor")

    def ranges(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], [], []]
            for order, row, text in _texts(batch):
                raw = np.frombuffer(text, np.uint8)
                view = memoryview(text)
                for lo, hi, _, h in anchors(raw, length, anchor):
                    keep = _in_filter(repeats.value, h)
                    lo, hi, h = lo[keep], hi[keep], h[keep]
                    whole = [hashlib.blake2b(view[a:b + length], digest_size=8).digest() for a, b in zip(lo.tolist(), hi.tolist())]
                    for col, v in zip(cols, (np.full(len(lo), order, np.int64), np.full(len(lo), row, np.int64), lo, hi, h,
                                             np.frombuffer(b"".join(whole), np.int64), _place(row, lo))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in cols],
                names=["_ord", "_row", "lo", "hi", "anchor", "whole", "place"])

    found = written(texts.mapInArrow(
        ranges, "_ord long, _row long, lo long, hi long, anchor long, whole long, place long"), "ranges")
    first = F.min(F.struct("_ord", "_row", "lo", "place"))["place"] if keep_first else F.min("place")
    kinds = written(found.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), first.alias("place")), "kinds")
    # ranges that are the same as a whole
    several = kinds.where("n > 1")
    if keep_first:
        twins = (found.join(several.select("anchor", "whole", F.col("place").alias("_first")), ["anchor", "whole"])
                 .where("place <> _first"))
    else:
        twins = found.join(several.select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    same = twins.select("_row", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    # one range of each kind, where an anchor has several
    sizes = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    chosen = written(kinds.join(sizes, "anchor").select("anchor", "place", (F.col("kinds") > run).alias("many")), "chosen")
    picked = _filter(chosen, "place")

    def samples(batches):
        kind = pa.schema([("anchor", pa.int64()), ("place", pa.int64()), ("_ord", pa.int64()), ("_row", pa.int64()),
                          ("lo", pa.int64()), ("bytes", pa.binary())])
        for batch in batches:
            for order, row, text in _texts(batch):
                view = memoryview(text)
                for lo, hi, _, h in anchors(np.frombuffer(text, np.uint8), length, anchor):
                    place = _place(row, lo)
                    at = np.flatnonzero(_in_filter(picked.value, place) & _in_filter(repeats.value, h)).tolist()
                    if at:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h[at]), pa.array(place[at]), pa.array([order] * len(at), pa.int64()),
                             pa.array([row] * len(at), pa.int64()),
                             pa.array(lo[at]), pa.array([bytes(view[lo[k]:hi[k] + length]) for k in at], pa.binary())],
                            schema=kind)

    # wrong hits of the filter go, and of equal rows, which share a place, one stays
    kept = written(texts.mapInArrow(samples, "anchor long, place long, _ord long, _row long, lo long, bytes binary")
                   .join(chosen, ["anchor", "place"]).dropDuplicates(["anchor", "place"])
                   .select("many", "anchor", "_ord", "_row", "lo", "bytes"), "samples")

    def compare(batches):
        """Rows come sorted by anchor, at most ``run`` of each; whole runs are
        compared, the last waits."""
        wait: list[pa.Table] = []
        for part in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            both = pa.concat_tables([*wait, pa.Table.from_batches([part])]).combine_chunks()
            h = both.column("anchor").to_numpy()
            cut = int(np.searchsorted(h, h[-1])) if len(h) else 0
            if cut:
                yield from _repeats_within(both.slice(0, cut), length, keep_first)
            wait = [both.slice(cut)]
        if wait and wait[0].num_rows:
            yield from _repeats_within(wait[0], length, keep_first)

    near = (kept.where("not many").select("anchor", "_ord", "_row", "lo", "bytes").repartition("anchor")
            .sortWithinPartitions("anchor").mapInArrow(compare, span_type))

    def digests(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                order, row, lo, a, b = _windows(part, length)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(order),
                                                  pa.array(row), pa.array(lo)], names=["a", "b", "_ord", "_row", "start"])

    tried = written(kept.where("many").select("_ord", "_row", "lo", "bytes").mapInArrow(
        digests, "a long, b long, _ord long, _row long, start long").distinct(), "window-digests")
    place = F.struct("_ord", "_row", "start")
    common = tried.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("_first")).where("n > 1")
    far = tried.join(common.select("a", "b", "_first"), ["a", "b"])
    if keep_first:
        far = far.where(place != F.col("_first"))
    far = far.select("_row", "start", (F.col("start") + length).alias("end"))
    return same.unionByName(near).unionByName(far)


def _windows(found: pa.RecordBatch | pa.Table, length: int):
    """Order, row, start and two hashes of every window of the kept ranges."""
    order, row, lo, data = (found.column(c) for c in ("_ord", "_row", "lo", "bytes"))
    data = data.combine_chunks() if isinstance(data, pa.ChunkedArray) else data
    data = data.cast(pa.large_binary())
    offs = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    begin, size = offs[:-1] - offs[0], np.diff(offs) - length + 1
    at = np.repeat(begin, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    starts = np.repeat(np.asarray(lo), size) + at - np.repeat(begin, size)
    return (np.repeat(np.asarray(order), size), np.repeat(np.asarray(row), size), starts,
            *(rolling(raw, length, b)[at] for b in _BASES))


def _repeats_within(found: pa.Table, length: int, keep_first: bool = False) -> Iterator[pa.RecordBatch]:
    rank, row, start, a, b = _windows(found, length)
    order = np.lexsort((start, row, rank, b, a))
    row, start, a, b = row[order], start[order], a[order], b[order]
    # neighbours in order with the same window; a place that came twice is one
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & ((row[1:] != row[:-1]) | (start[1:] != start[:-1]))
    twin = np.append(False, same)
    if not keep_first:
        twin |= np.append(same, False)
    row, start = row[twin], start[twin]
    # windows side by side become one span
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    if len(row):
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)))
        last = np.append(first[1:], len(row)) - 1
        yield pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(start[first]), pa.array(start[last] + length)],
                                         names=["_row", "start", "end"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, run: int = RUN, kept_col: str = "kept", as_text: bool = False,
                   keep_first: bool = False) -> DataFrame:
    """The other columns of ``df`` with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept``: the bytes of each whole text that no
    repeated string of ``length`` bytes covers, as binary (a cut may fall
    inside a character); with ``as_text`` a string without such broken
    characters.

    Strings are judged on the input; each place counts, so all copies go, and
    an equal row is another place. With ``keep_first`` the first copy stays:
    that of the least id (of integral ids; others go by a fixed hash; null ids
    come last), then of the first place in the text; rows with equal id and
    text are then one place and are cut alike. Null texts are empty; texts
    shorter than ``length`` stay whole; very long texts are hashed by segments
    of 1 MB that overlap by a window. An empty table gives an empty table.
    Columns that bear an output's name are replaced, all others are kept,
    whatever their names.
    """
    bounded_batches(df.sparkSession)
    names = ["n_bytes", "n_removed", "n_spans"]
    kept = others(df, text_col, kept_col, *names)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = F.lit(0).cast("long")
    if keep_first:
        integral = isinstance(df.schema[id_col].dataType, T.IntegralType)
        order = F.coalesce(F.col(id_col).cast("long") if integral else F.xxhash64(id_col), F.lit(2**63 - 1))
    # the other columns travel in one struct, so that none meets an inner name
    rest = F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)]).alias("_rest")
    base = df.select(rest, order.alias("_ord"), F.xxhash64(F.col(id_col), text).alias("_row"), text.alias("_text"))
    spans = repeated_spans(base.select("_ord", "_row", "_text").where(F.octet_length("_text") >= length), length, anchor, run,
                           keep_first)
    per_row = spans.groupBy("_row").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    joined = base.join(per_row, "_row", "left").select(
        *[F.col(f"_rest.c{k}") for k in range(len(kept))], F.col("_spans"), F.col("_text"))
    out = schema_of(df.select(*kept), *[T.StructField(n, T.LongType(), False) for n in names],
                    T.StructField(kept_col, T.StringType() if as_text else T.BinaryType(), False))

    def apply(batches):
        for batch in batches:
            sizes, left = [], []
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            spans_col = batch.column(batch.num_columns - 2)
            for text, found in zip(texts, spans_col):
                data = text.as_buffer().to_pybytes()
                parts, at, removed, runs = [], 0, 0, 0
                end_before = -1
                for s in sorted((s["start"], s["end"]) for s in found.as_py() or ()):
                    if s[0] > end_before:
                        runs += 1
                        parts.append(data[at:s[0]])
                        at = s[0]
                    removed += max(0, s[1] - max(at, s[0]))
                    at = end_before = max(at, s[1])
                parts.append(data[at:])
                sizes.append((len(data), removed, runs))
                rest = b"".join(parts)
                left.append(rest.decode("utf-8", "ignore") if as_text else rest)
            cols = list(zip(*sizes)) if sizes else [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *[pa.array(c, pa.int64()) for c in cols],
                                              pa.array(left, pa.string() if as_text else pa.binary())], names=out.names)

    return joined.mapInArrow(apply, out)
