"""Readers for the driver tables (one Parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning and filters are pushed into the scan by
    Catalyst, so callers select only what they need."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv_transactions(spark: SparkSession, path: str, schema, time_col: str = "timestamp",
                          seconds_col: str = "Time", base: str = "2024-01-01 00:00:00") -> DataFrame:
    """CSV with a declared schema (no inference). The timestamp is
    parsed from ``time_col`` when present, else derived as ``base`` plus
    ``seconds_col`` seconds. Order is not a property of a DataFrame, so the
    load does not sort; every ordered operator sorts by (ts, id) itself."""
    from vigil.sources.adapters import derive_timestamp
    df = spark.read.schema(schema).option("header", True).csv(path)
    if time_col in df.columns:
        return derive_timestamp(df, text_col=time_col, out="ts")
    return derive_timestamp(df, seconds_col=seconds_col, base=base, out="ts")
