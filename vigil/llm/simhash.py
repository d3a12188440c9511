"""SimHash near-duplicates by an inverted index over byte positions.

Two fingerprints that differ in at most ``max_bits`` bits share at least
``8 - max_bits`` of their eight bytes at the same positions, so any such pair
shares all the bytes of at least one small set of positions. The index posts
every distinct fingerprint under those position sets; for pairs that meet in a
posting, shared positional bytes are tallied, pairs that reach the guaranteed
minimum stay, and their differing bits are counted.

A posting longer than ``LONG_POSTING`` (a large group of near copies) is not
paired. Its fingerprints are linked exactly by another route that costs the
same for each: two fingerprints are within two bits of each other if and only
if some value lies within one bit of both, so each goes to the 65 values within
one bit of it, and all that meet at a value are linked to the least of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import bounded_batches, others, schema_of, written
from vigil.llm.links import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: fingerprints in a posting whose pairs are still tallied one by one
LONG_POSTING = 32
#: hashes whose bits are summed at once
_CHUNK = 1 << 16


def fingerprint_text(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the word shingles of a UTF-8 text: bit i is 1 if set in over
    half the shingles' XXH64. bytes.lower and bytes.split know A-Z and the six
    ASCII blanks only."""
    import xxhash
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "simhash",
                 words: int = SHINGLE_WORDS, keep_text: bool = False) -> DataFrame:
    """The other columns of ``df`` (with ``keep_text`` the text too) and the
    fingerprint of each whole text as a signed long. A null text, or one
    without a word, has fingerprint zero."""
    bounded_batches(df.sparkSession)
    kept = others(df, out_col, *([] if keep_text else [text_col]))
    out = schema_of(df.select(*kept), T.StructField(out_col, T.LongType(), False))

    def task(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            values = np.fromiter((fingerprint_text(t.as_buffer().to_pybytes() if t.is_valid else b"", words)
                                  for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values.view(np.int64))], names=out.names)

    return df.select(*kept, F.col(text_col).cast("string").alias("_text")).mapInArrow(task, out)


def _blocks(max_bits: int) -> list[list[int]]:
    """The eight byte positions in max_bits + 2 groups."""
    return [p.tolist() for p in np.array_split(np.arange(8), max_bits + 2)]


def position_sets(max_bits: int) -> list[list[int]]:
    """Sets of byte positions of which every pair within ``max_bits`` bits
    shares one: differing bits touch at most ``max_bits`` of max_bits + 2
    groups, so at least two groups are the same."""
    return [a + b for a, b in combinations(_blocks(max_bits), 2)]


def _mask(positions: list[int]) -> int:
    value = sum(0xFF << 8 * p for p in positions)
    return value - (1 << 64) if value >> 63 else value


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, long_posting: int = LONG_POSTING) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits`` bits of
    each other. ``prints``: distinct longs in column ``fp``. For max_bits = 2."""
    if max_bits != 2:
        raise ValueError("long postings are linked over values within one bit, which is two bits between two")
    prints = prints.select("fp")
    sets = F.array(*[F.struct(F.lit(k).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("v"))
                     for k, p in enumerate(position_sets(max_bits))])
    posted = written(prints.select("fp", F.inline(sets)), "postings")
    length = posted.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    short = length.where(F.col("n") <= long_posting).select("s", "v")
    # each posting is one small array; its pairs are made where it lies
    gathered = (posted.join(short, ["s", "v"]).groupBy("s", "v").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
                .select(F.explode("fps").alias("a"), "fps").select("a", F.explode(F.filter("fps", lambda b: b > F.col("a"))).alias("b")))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum(F.when(differ.bitwiseAND(F.lit(_mask([p]))) == 0, 1).otherwise(0) for p in range(8))
    pairs = (gathered.withColumn("shared", shared).where(F.col("shared") >= 8 - max_bits)
             .where(F.bit_count(differ) <= max_bits).select("a", "b"))
    crowded = (posted.join(length.where(F.col("n") > long_posting).select("s", "v"), ["s", "v"], "left_semi")
               .select("fp").distinct())
    bits = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
    values = F.concat(F.array(F.col("fp")), F.transform(F.array(*map(F.lit, bits)), lambda b: F.col("fp").bitwiseXOR(b)))
    meet = crowded.select("fp", F.explode(values).alias("v"))
    least = meet.groupBy("v").agg(F.min("fp").alias("a"), F.max("fp").alias("_b"), F.collect_set("fp").alias("fps"))
    stars = least.where("a <> _b").select("a", F.explode("fps").alias("b")).where("a <> b")
    return pairs.unionByName(stars).distinct()


def _named(prints: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """Distinct fingerprints fp with the root of their component and their
    least id. ``prints``: id and fp."""
    classes = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    found = components(near_links(classes, max_bits), "simhash-links")
    return classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("component", "fp")).select("fp", "root", "least")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: id, ``fingerprint`` (16 hex digits),
    ``component_id``: the smallest id reachable over links of ``max_bits``
    bits. Rows without a word have fingerprint zero and are linked as any
    other. Repeated rows stay; a null id takes part, but names no component
    unless all its component's ids are null. Other columns are not kept."""
    prints = written(fingerprints(df.select(id_col, text_col), text_col, "fp", words), "prints")
    named = written(_named(prints, id_col, max_bits), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` of which one of each component stays: that with the
    smallest id (null ids last), of several such the one with the smallest
    hash of id and text. Every text is fingerprinted once; the rows that stay
    are found by that hash. All columns are kept, whatever their names. An
    empty table gives an empty table."""
    key = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
    keyed = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    prints = written(fingerprints(keyed, "text", "fp", words), "prints")
    classes = written(prints.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))).alias("least")), "classes")
    found = components(near_links(classes, max_bits), "simhash-links").withColumnRenamed("id", "fp")
    stays = (classes.join(found, "fp", "left").groupBy(F.coalesce("component", "fp")).agg(F.min("least").alias("least"))
             .select(F.col("least.key").alias("_stay")))
    rest = [F.col(c).alias(f"c{k}") for k, c in enumerate(df.columns)]
    one = (df.select(*rest, key.alias("_key")).join(stays, F.col("_key") == F.col("_stay"), "left_semi")
           .dropDuplicates(["_key"]))
    return one.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)])
