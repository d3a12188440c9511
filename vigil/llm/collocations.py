"""Phrase collocations by count transducers.

1. Build. A task cuts its texts into pieces and words, sorts the phrases of a
   batch and makes a weighted automaton of them; a shard's automata are united
   as they come. The phrase of up to three words that starts at a word
   stands for all its beginnings, and every word for itself.
2. Union. A shard's automaton is cut by prefix range: ranges of the hash of a
   phrase's first two words, so a frequent first word spreads over many. Per
   language and range, the shards' automata are united and weights summed;
   counts of two-word beginnings are sums over their states. Phrases that reach
   the least count leave the task, all others end there.
3. Compose. Parts of candidates go to the range of the part, where they are read
   through the transducer of the frequent phrases; scores are exact decimals.

A task holds one shard of bounded size, or one range, whose size is set by the
bytes of text; a phrase comes once from each shard, however often it stands
there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.llm import automata, pretokens as pt
from vigil.llm.common import bounded_batches, written

LEAST = 10
FIRST = 2000
INSIDE_SHARE = 50
UNKNOWN = "und"
#: phrases in a shard's automaton before it is cut and sent
SHARD_PHRASES = 3_000_000
#: bytes of text to a prefix range
RANGE_BYTES = 24 << 20
#: phrases of a range that wait for a union
WAIT_PHRASES = 2_000_000
#: shares of a language's phrases that are ranked by themselves before the last ranking
SHARES = 64
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)

# byte classes (fixed values): blanks part words, the others part pieces
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def count_phrases(texts: pa.Array) -> automata.Grams:
    """Phrases of a block of texts: each word by itself, and from each word the
    longest phrase of two or three words that starts there inside its piece."""
    parts = []
    for _, _, data, offs in pt.blocks(texts, 8 << 20):
        raw = np.frombuffer(data.to_pybytes().translate(_LOWER), np.uint8)
        kind = _CLASS[raw]
        inked = np.zeros(len(raw) + 2, bool)
        inked[1:-1] = kind == 0
        edge = np.zeros(len(raw) + 1, bool)
        edge[offs] = True
        starts = np.flatnonzero(inked[1:] & (~inked[:-1] | edge))
        ends = np.flatnonzero(inked[:-1] & (~inked[1:] | edge))
        if not len(starts):
            continue
        cuts = np.empty(2 * len(starts) + 1, np.int32)
        cuts[:-1:2], cuts[1::2], cuts[-1] = starts, ends, len(raw)
        words = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        words = words.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
        order = words.dictionary
        at = pc.sort_indices(order).to_numpy()
        rank = np.empty(len(at), np.int32)
        rank[at] = np.arange(1, len(at) + 1)
        one = rank[words.indices.to_numpy()]
        # pieces and rows that end between a word and the next
        closed = np.cumsum(np.append((kind == 2), False) | edge)
        apart = np.append(closed[starts[1:]] != closed[ends[:-1] - 1], True)
        two = np.where(apart, 0, np.append(one[1:], 0))
        three = np.where(apart | np.append(apart[1:], True), 0, np.append(one[2:], [0, 0])[:len(one)])
        labels = np.stack([one, two, three], axis=1)
        single = np.bincount(one, minlength=len(at) + 1)[1:]
        alone = np.zeros((len(at), automata.MOST), np.int32)
        alone[:, 0] = np.arange(1, len(at) + 1)
        labels = labels[two > 0]
        labels, weights = automata.sort_and_sum(np.concatenate([alone, labels]),
                                                np.append(single, np.ones(len(labels), np.int64)), len(at) + 1)
        parts.append(automata.Grams(order.take(pa.array(at)), labels, weights))
    return automata.union(parts)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def prefix_ranges(grams: automata.Grams, ranges: int) -> np.ndarray:
    """Prefix range of each phrase: by the hash of its first two words."""
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in grams.words.to_pylist()), np.uint64, len(grams.words))
    own = np.append(np.uint64(1), own)
    a, b = grams.labels[:, 0], grams.labels[:, 1]
    hashed = _mix(own[a] * np.uint64(_MIX[0]) ^ _mix(own[b]))
    # the upper half of the hash, laid evenly over the ranges
    return ((hashed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _by_range(grams: automata.Grams, ranges: int):
    """(range, transducer of its phrases)."""
    if not len(grams):
        return
    of = prefix_ranges(grams, ranges)
    order = np.argsort(of, kind="stable")
    begin = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
    for rows in np.split(order, begin[1:]):
        yield int(of[rows[0]]), automata.Transducer.build(automata.part(grams, rows))


def _phrases(grams: automata.Grams, rows: np.ndarray, words: int) -> pa.Array:
    cols = [grams.words.take(pa.array(grams.labels[rows, k] - 1)) for k in range(words)]
    return pc.binary_join_element_wise(*cols, pa.scalar(b" ", pa.binary())) if words > 1 else cols[0]


def frequent_phrases(df: DataFrame, text_col: str, lang_col: str, least: int = LEAST) -> DataFrame:
    """(lang, range, words, phrase, f): all phrases of one to three words that
    stand at least ``least`` times, with their exact counts; and per language
    and range a row with words 0: all word occurrences counted there."""
    spark = df.sparkSession
    bounded_batches(spark)
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))

    def shards(batches):
        held: dict[str, list] = {}

        def sent(lang):
            for r, made in _by_range(automata.union(held.pop(lang)), ranges):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([r], pa.int64()), pa.array([made.to_bytes()], pa.binary())],
                                                 names=["lang", "range", "automaton"])

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = batch.column(1).take(pa.array(np.flatnonzero(langs.indices.to_numpy() == k)))
                held.setdefault(lang, []).append(count_phrases(own))
                if sum(map(len, held[lang])) > SHARD_PHRASES:
                    held[lang] = [automata.union(held[lang])]
            while sum(len(g) for own in held.values() for g in own) > SHARD_PHRASES:
                yield from sent(max(held, key=lambda x: sum(map(len, held[x]))))
        for lang in list(held):
            yield from sent(lang)

    cut = texts.mapInArrow(shards, "lang string, range long, automaton binary")

    def unite(batches):
        at, wait = None, []
        for batch in batches:
            for lang, r, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if at != (lang, r):
                    yield from finished(at, wait)
                    at, wait = (lang, r), []
                wait.append(automata.Transducer.from_bytes(data).grams())
                if sum(map(len, wait[1:])) > WAIT_PHRASES:
                    wait = [automata.union(wait)]
        yield from finished(at, wait)

    def finished(at, wait):
        if not wait:
            return
        grams = automata.union(wait)
        a, b, c = grams.labels.T
        longer = b > 0
        rows = np.flatnonzero(~longer)
        yield from found(at, 0, pa.array([b""], pa.binary()), grams.weights[rows].sum()[None])
        rows = rows[grams.weights[rows] >= least]
        yield from found(at, 1, _phrases(grams, rows, 1), grams.weights[rows])
        rows = np.flatnonzero(longer & (c > 0) & (grams.weights >= least))
        yield from found(at, 3, _phrases(grams, rows, 3), grams.weights[rows])
        rows = np.flatnonzero(longer)
        if len(rows):  # a beginning's count: the weights of all that follows it
            first = np.flatnonzero(np.append(True, (a[rows[1:]] != a[rows[:-1]]) | (b[rows[1:]] != b[rows[:-1]])))
            total = np.add.reduceat(grams.weights[rows], first)
            yield from found(at, 2, _phrases(grams, rows[first][total >= least], 2), total[total >= least])

    def found(at, words, phrases, counts):
        if len(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(counts)), pa.array(np.full(len(counts), at[1])), pa.array(np.full(len(counts), words, np.int32)),
                 phrases.cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "range", "words", "phrase", "f"])

    return (cut.repartition("lang", "range").sortWithinPartitions("lang", "range")
            .mapInArrow(unite, "lang string, range long, words int, phrase string, f long"))


def part_counts(parts: DataFrame, frequent: DataFrame, ranges: int) -> DataFrame:
    """``parts`` (lang, part, other columns) with ``f``, the part's count in
    ``frequent`` (lang, phrase, f): both are dealt by the part's prefix range,
    and parts are read through the transducer of that range."""
    kept = [c for c in parts.columns if c not in ("lang", "part")]
    deal = F.pmod(F.xxhash64("lang", "part"), F.lit(ranges)).alias("range")
    empty = [F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in kept]
    both = (frequent.select("lang", F.col("phrase").alias("part"), F.lit(0).alias("side"), "f", *empty).unionByName(
        parts.select("lang", "part", F.lit(1).alias("side"), F.lit(None).cast("long").alias("f"), *kept))
        .select("lang", deal, "side", "part", "f", *kept).repartition("lang", "range").sortWithinPartitions("lang", "range", "side"))
    out = both.select("lang", "part", "f", *kept).schema

    def read(batches):
        at, known, made = None, [], None
        for batch in batches:
            langs, ranges_, sides = (batch.column(k).to_pylist() for k in range(3))
            keys = list(zip(langs, ranges_, sides))
            begin = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for i, j in zip(begin, [*begin[1:], len(keys)]):
                rows = batch.slice(i, j - i)
                if at != keys[i][:2]:
                    at, known, made = keys[i][:2], [], None
                if keys[i][2] == 0:
                    known.append(automata.of_phrases(rows.column(3), rows.column(4).to_numpy()))
                    made = None
                    continue
                made = made or automata.Transducer.build(automata.union(known))
                f = automata.compose(rows.column(3), made)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(3), pa.array(f), *rows.columns[5:]], names=out.names)

    return both.mapInArrow(read, out)


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, first: int = FIRST,
                 inside_share: int = INSIDE_SHARE) -> DataFrame:
    """Per language the first ``first`` phrases of two or three words by score:
    lang, rank, phrase, a, l, r, n, score.

    a, l and r are the counts of the phrase and of the two parts of its
    lowest-scoring cut, n counts all words, score = floor(10^6 a a / (l r)). A
    phrase needs ``least`` occurrences, and goes if a longer candidate that
    holds it has at least ``inside_share`` percent of them. Null texts are
    empty, a null language is ``und``; languages without a candidate have no
    row, nor has an empty table. Very long texts are read whole, in one block;
    repeated rows count each. Other columns play no part, whatever their names.
    """
    counted = written(frequent_phrases(df, text_col, lang_col, least), "phrases")
    totals = counted.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.where("words > 0").select("lang", "words", "phrase", "f")
    candidates = frequent.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    word = F.split("phrase", " ", -1)
    join = lambda i, n: F.array_join(F.slice(word, i, n), " ")
    sides = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("left"), join(F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit(False).alias("left"), join(k + 1, F.col("words") - k).alias("part"))))
    parts = candidates.select("lang", "phrase", "a", F.inline(F.flatten(sides))).select("lang", "part", "phrase", "a", "k", "left")
    ranges = max(1, -(-frequent.count() // SHARD_PHRASES)) * 8
    cuts = part_counts(parts, frequent, ranges).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumns({f"_{c}": v for c, v in exact.items()}).withColumn(
        "score", F.expr("(_a * _a * CAST(1000000 AS DECIMAL(7,0))) DIV (_l * _r)"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # of the longer candidates that hold a phrase, the most frequent decides
    held = candidates.where("words > 2").select("lang", F.col("a").alias("more"), F.explode(F.flatten(
        F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
            F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(word, i, n), " "))))).alias("phrase"))
    gone = held.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    left = best.join(gone, ["lang", "phrase"], "left").where(
        F.col("more").isNull() | (F.col("more") * 100 < F.col("a") * inside_share))
    order = (F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    # the first of every share of a language, so that no task sorts all its phrases
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = left.withColumn("share", share).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= first)
    top = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("long").alias("score"))
