"""What the operators of this package share: tables, the shared folder for
written intermediate tables, and bounded Arrow batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vigil.session import ensure_checkpoint_dir

#: bytes of text in one Arrow batch that goes to a Python worker
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded by rows and by bytes, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again:
    it cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def others(df: DataFrame, *but: str) -> list[str]:
    """Columns of ``df`` without those named (names compare as Spark does)."""
    gone = {b.lower() for b in but}
    return [c for c in df.columns if c.lower() not in gone]


def schema_of(df: DataFrame, *added: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *added])
