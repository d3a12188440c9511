"""Join helpers: lookups broadcast only behind a checked size bound."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import ensure_checkpoint_dir, shared_dir

# A lookup table is broadcast only when it was counted to have at most so many
# rows and bytes; beyond that the join is a plain shuffle join (AQE may still
# pick broadcast from runtime statistics, which is its own size check).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 for a fixed-size value, else those of its text form."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        fixed = isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))
        text = F.col(f"`{f.name}`") if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(f"`{f.name}`"))
        size = size + (F.lit(8) if fixed else F.coalesce(F.octet_length(text), F.lit(0)) + 8)
    return size


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """A plain count and sum: partial results are added up, no row is moved."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def kept(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder, so that a size check and a join
    compute it once. Its files go when the DataFrame is no longer referenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``); no cache stays."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under a name of its own in the shared checkpoint
    folder, for a source that many passes read: it is parsed once, and each pass
    reads the columns and row groups it needs."""
    path = shared_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(big: DataFrame, table: DataFrame, on, how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join with a lookup table, usually an aggregate over a large input."""
    table = kept(table)
    return big.join(F.broadcast(table) if is_small(table, max_rows, max_bytes) else table, on=on, how=how)
