"""Side-by-side check of a registered query against its DuckDB oracle."""

from __future__ import annotations

import math
import os

import numpy as np
import pandas as pd

from vigil.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v):
    import decimal
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", str(v))  # a decimal never equals a double in a value hash
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, (np.floating,)):
        return round(float(v), 9)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (bool, np.bool_)):
        return int(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm_value(x)) for k, x in v.asDict().items()))
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm_value(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_recs = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_recs = res.fetchall()
    sc, sr = _rows(s_cols, s_recs)
    dc, dr = _rows(d_cols, d_recs)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "spark_columns": sc, "oracle_columns": dc}
    mismatches = [(a, b) for a, b in zip(sr, dr) if a != b]
    out["value_mismatches"] = len(mismatches) + abs(len(sr) - len(dr))
    out["examples"] = mismatches[:3]
    out["ok"] = out["columns_match"] and out["value_mismatches"] == 0
    return out
