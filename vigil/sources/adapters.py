"""Canonical transaction schema and adapters from source tables.

The canonical table has one row per transaction with a unique
``transaction_id``; every ordered feature breaks timestamp ties on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import ROLES

CANONICAL_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("merchant_id", T.LongType(), True),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("label", T.IntegerType(), True),
])


#: ids may be strings in the source
ID_COLUMNS = ("transaction_id", "customer_id", "merchant_id")


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns) -> None:
    """Fail fast listing every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")


def to_transactions(df: DataFrame, mapping: dict[str, Column | str], keep=()) -> DataFrame:
    """Generic adapter: ``mapping`` maps canonical name -> source column or
    expression. Unmapped canonical columns become typed nulls. Of the other
    columns those in ``keep`` stay, as doubles (raw model inputs, which must be
    there); helper columns are dropped. Ids that are strings stay strings. Null amounts are rejected
    downstream by ``reject_null_amounts``."""
    require_columns(df, keep)
    cols = []
    for field in CANONICAL_SCHEMA.fields:
        src = mapping.get(field.name)
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            c = F.col(src) if isinstance(src, str) else src
            own = df.select(c).schema[0].dataType
            kind = own if field.name in ID_COLUMNS and isinstance(own, T.StringType) else field.dataType
            cols.append(c.cast(kind).alias(field.name))
    return df.select(*cols, *[F.col(f"`{k}`").cast("double").alias(k) for k in keep])


def reject_null_amounts(tx: DataFrame) -> DataFrame:
    """Rows whose amount is null or NaN break window sums; keep them out."""
    a = F.col(ROLES.amount)
    return tx.where(a.isNotNull() & ~F.isnan(a))


def event_merchant_key() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def transactions_from_events(events: DataFrame, keep=()) -> DataFrame:
    """events -> canonical: merchant = props.k, category = k % 10,
    device = 'DEV_' || (k div 5), label = error event with value > 60.
    Rows without a usable amount are rejected; columns in ``keep`` stay."""
    k = event_merchant_key()
    return reject_null_amounts(to_transactions(events, {
        "transaction_id": "event_id",
        "customer_id": "user_id",
        "merchant_id": k,
        "merchant_category": (k % 10).cast("string"),
        "device_id": F.concat(F.lit("DEV_"), (k / 5).cast("bigint").cast("string")),
        "ts": "ts",
        "amount": "value",
        "label": ((F.col("event_type") == "error") & (F.col("value") > 60)).cast("int"),
    }, keep))


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> canonical: day-grained timestamps with real ties. Rows
    without a usable amount are rejected."""
    return reject_null_amounts(to_transactions(orders, {
        "transaction_id": "o_orderkey",
        "customer_id": "o_custkey",
        "merchant_category": "o_orderpriority",
        "device_id": "o_orderstatus",
        "ts": "o_orderdate",
        "amount": "o_totalprice",
    }))


def derive_timestamp(df: DataFrame, seconds_col: str | None = None, text_col: str | None = None,
                     base: str = "2024-01-01 00:00:00", out: str = "ts") -> DataFrame:
    """S3: timestamp = base + seconds offset, or parsed from text."""
    if seconds_col is not None:
        base_us = F.unix_micros(F.to_timestamp(F.lit(base)))
        us = base_us + F.round(F.col(seconds_col) * 1_000_000).cast("bigint")
        return df.withColumn(out, F.timestamp_micros(us).cast("timestamp_ntz"))
    if text_col is not None:
        return df.withColumn(out, F.to_timestamp_ntz(F.col(text_col)))
    raise ValueError("need seconds_col or text_col")
