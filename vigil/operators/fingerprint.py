"""Data fingerprint (A20): row count, content digest, time range.

SHA-256 is sequential, so one digest over all keys would funnel the table
through one task. The digest is defined on three levels, the same at every
size: keys go to 16**3 buckets by the first three hex digits of their MD5; a
bucket's digest is SHA-256 over its sorted keys, joined by newlines; the
digests of the buckets that share two digits are digested in bucket order, and
so are those 256 in turn. It is not the digest of the sorted key list itself.

Buckets are sorted by Spark's external sort and digested as their rows pass, so
a task holds a batch of keys whatever a bucket's size. Identical rows in any
order give the same fingerprint; keys may be of any type, null keys are left
out of the digest and counted.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import ROLES

BUCKET_DIGITS = 3
GROUP_DIGITS = 2


def row_keys(df: DataFrame) -> F.Column:
    """Key per row: the transaction id, else ts|customer|merchant|amount."""
    if ROLES.transaction_id in df.columns:
        return F.col(ROLES.transaction_id).cast("string")
    parts = [F.col(c).cast("string") for c in (ROLES.ts, ROLES.customer, ROLES.merchant, ROLES.amount)
             if c in df.columns]
    return F.concat_ws("|", *parts)


def _bucket_digests(batches):
    """Rows sorted by (bucket, key): digest and size of each bucket, in passing."""
    at, digest, n = None, None, 0
    for batch in batches:
        runs = batch.column(0).dictionary_encode()
        begin = 0
        for bucket, size in zip(runs.dictionary.to_pylist(), runs.indices.value_counts().field(1).to_pylist()):
            if bucket != at:
                if digest:
                    yield _record(at, digest, n)
                at, digest, n = bucket, hashlib.sha256(), 0
            keys = batch.column(1).slice(begin, size).drop_null()
            if len(keys):
                digest.update((b"\n" if n else b"") + b"\n".join(keys.cast(pa.binary()).to_pylist()))
            begin, n = begin + size, n + len(keys)
    if digest:
        yield _record(at, digest, n)


def _record(bucket: str, digest, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], names=["_b", "_n", "_d"])


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n_rows, content_sha256, date_min, date_max. An empty table has
    the digest of the empty string."""
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ROLES.ts).alias("date_min"), F.max(ROLES.ts).alias("date_max"))
    keyed = df.select(row_keys(df).alias("_k")).where("_k is not null")
    buckets = (keyed.select(F.substring(F.md5(F.col("_k").cast("binary")), 1, BUCKET_DIGITS).alias("_b"), "_k")
               .repartition("_b").sortWithinPartitions("_b", "_k").mapInArrow(_bucket_digests, "_b string, _n long, _d string"))

    def above(level: DataFrame, *keys) -> DataFrame:
        in_order = F.transform(F.sort_array(F.collect_list(F.struct("_b", "_d"))), lambda s: s["_d"])  # 256 digests at most
        return level.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sha2(F.array_join(in_order, "\n"), 256).alias("_d"))

    groups = above(buckets, F.substring("_b", 1, GROUP_DIGITS).alias("_g")).withColumnRenamed("_g", "_b")
    return above(groups).crossJoin(rows).select(  # one row each
        F.col("n_rows").cast("bigint").alias("n_rows"), F.col("_d").alias("content_sha256"), "date_min", "date_max")
