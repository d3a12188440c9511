"""Chronological splits and ordered cuts.

Cut points are ``int(n * frac)`` computed in Python floats on the driver
(so ``int(90 * 0.7) == 62`` as in the reference), then turned into the
(ts, transaction_id) keys of the rows at those global positions. The split
label is then a plain projection with literal bounds: no join and no
shuffle of the full table, and the bounds push down into Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import RANDOM_STATE, ROLES, TRAIN_FRAC, VAL_FRAC
from vigil.operators.select import keys_at

# Cut bounds are (ts, transaction_id) literals typed like the ts column, so
# split predicates reach the Parquet scan (row groups are skipped when the
# data is laid out by time).
ORDER = (ROLES.ts, ROLES.transaction_id)
SPLITS = ("train", "val", "test")


def _fraction(value, default, name):
    if value is None:
        return default
    if value <= 0.0:
        raise ValueError(f"{name} must be > 0, got {value!r}")
    return float(value)


def split_cuts(n: int, train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC) -> tuple[int, int]:
    return int(n * train_frac), int(n * (train_frac + val_frac))


def _typed(df: DataFrame, bound: tuple) -> tuple:
    ts_type = df.schema[ROLES.ts].dataType
    return (F.lit(bound[0]).cast(ts_type), F.lit(bound[1]).cast(df.schema[ROLES.transaction_id].dataType))


def before(df: DataFrame, bound: tuple | None):
    """Rows strictly before ``bound`` in (ts, transaction_id) order."""
    if bound is None:
        return F.lit(True)
    ts, tid = _typed(df, bound)
    return (F.col(ROLES.ts) < ts) | ((F.col(ROLES.ts) == ts) & (F.col(ROLES.transaction_id) < tid))


def label_by_cuts(df: DataFrame, bounds: list[tuple | None], labels, col: str = "split") -> DataFrame:
    """Assign labels[i] to rows before bounds[i] (None = the cut is at the
    end of the table), the last label to the rest."""
    expr = None
    for bound, lab in zip(bounds, labels):
        cond = before(df, bound)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    expr = expr.otherwise(labels[len(bounds)]) if expr is not None else F.lit(labels[0])
    return df.withColumn(col, expr)


def in_split(df: DataFrame, info: dict, name: str):
    """Direct predicate for one split (pushes into the scan), equivalent to
    ``split == name``."""
    b1, b2 = info["bounds"]
    if name == "train":
        return before(df, b1)
    if name == "val":
        return ~before(df, b1) & before(df, b2)
    return ~before(df, b2)


def time_split(tx: DataFrame, train_frac: float | None = None,
               val_frac: float | None = None) -> tuple[DataFrame, dict]:
    """L1: adds ``split`` in {train, val, test}. Returns (frame, info) where
    info holds n and the two integer cut points."""
    train_frac = _fraction(train_frac, TRAIN_FRAC, "train_frac")
    val_frac = _fraction(val_frac, VAL_FRAC, "val_frac")
    n = tx.count()
    c1, c2 = split_cuts(n, train_frac, val_frac)
    keys = keys_at(tx, ORDER, [c for c in (c1, c2) if c < n])
    bounds = [keys.get(c1), keys.get(c2)]
    out = label_by_cuts(tx, bounds, SPLITS)
    return out, {"n": n, "train_end": c1, "val_end": c2, "bounds": bounds}


def split_summary(split_tx: DataFrame, label: str = ROLES.label) -> DataFrame:
    """L2: size, positives and positive rate per split."""
    return (split_tx.groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(label).cast("bigint").alias("n_positive"),
                 F.avg(label).alias("positive_rate")))


def tail_from(tx: DataFrame, start: int) -> DataFrame:
    n = tx.count()
    if start <= 0:
        return tx
    if start >= n:
        return tx.limit(0)
    key = keys_at(tx, ORDER, [start])[start]
    return tx.where(~before(tx, key))


def newest_window(tx: DataFrame, window_frac: float) -> DataFrame:
    """L3: the newest fraction, from position int(n * (1 - frac))."""
    n = tx.count()
    return tail_from(tx, int(n * (1.0 - window_frac)))


def first_n(tx: DataFrame, n_rows: int) -> DataFrame:
    """The first n rows in (ts, id) order, as a filter on the key of row
    n (no single-task top-n for large n)."""
    n = tx.count()
    if n_rows >= n:
        return tx
    if n_rows <= 0:
        return tx.limit(0)
    key = keys_at(tx, ORDER, [n_rows])[n_rows]
    return tx.where(before(tx, key))


def hash_sample(df: DataFrame, n: int, key: str = ROLES.transaction_id,
                seed: int = RANDOM_STATE) -> DataFrame:
    """Deterministic sample of min(n, len) rows without replacement: the
    n smallest MD5 of "key|seed" (as text), ties by key. A top-n with a bounded n (it is a sample
    size), so the single-task merge holds at most n rows."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def regime_cut(tx: DataFrame, frac: float, labels=("before", "after"), col: str = "regime") -> DataFrame:
    """L4: one chronological cut at int(n * frac); rows before it get
    labels[0], the rest labels[1]."""
    n = tx.count()
    c = int(n * frac)
    key = keys_at(tx, ORDER, [c]).get(c) if c < n else None
    return label_by_cuts(tx, [key], labels, col)
