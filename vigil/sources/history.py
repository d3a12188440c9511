"""Append-only history tables (S6-S8): one JSON record per cycle/decision.

Records are written as JSON lines partitioned by day so later reads prune by
date; reads use a declared schema. A history that was never written is an empty
DataFrame; anything else that cannot be read is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_history(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    (df.withColumn("dt", F.to_date(F.col(ts_col)))
       .write.mode("append").partitionBy("dt").json(path))


def write_record(df: DataFrame, path: str, key: str, value) -> None:
    """The records of one batch (or run) under ``key=value``. Written again,
    they replace themselves: a rerun leaves the same rows. ``load_history``
    reads ``key`` back as a column."""
    df.drop(key).write.mode("overwrite").json(f"{path.rstrip('/')}/{key}={value}")


def load_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Report sinks (model comparison as JSON, importances as CSV), as many
    files as the report has partitions; a rerun replaces the report."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)
