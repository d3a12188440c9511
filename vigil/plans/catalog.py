"""Query catalogue: every registered query is a function (spark, sf_dir) ->
DataFrame over the driver tables, optionally paired with an independently
phrased DuckDB SQL oracle over the same Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from vigil.plans import (  # noqa: F401
        q_features, q_metrics, q_drift, q_decisions, q_misc, q_models, q_streaming,
    )
