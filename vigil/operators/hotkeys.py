"""Causal features for hot keys without a per-key task (skew path).

A window partitioned by customer puts all of a customer's rows in one task;
if one customer holds a third of the table, that task holds a third of the
table. For such keys (a null key is one like any other) the same features are
running sums along the total order (keys, ts, kind, id), which one range
shuffle splits into balanced blocks regardless of how many rows a key has:

  kind 0+j  expiry: a row leaves window j at ts + w_j, before any row at that
            time arrives
  kind M    device marker: the first row of a (key, device) pair that is not a
            known device, just before that row; or with no device, the key's
            start, carrying its known-device count
  kind M+1  data row: it arrives

  velocity_j       = arrivals of the key so far - expiries of window j so far
  recency          = ts - ts of the key's previous data row
  is_new_device    = a marker with the row's id stands just before it
  distinct_devices = known count + the key's markers so far

Every event is read once, in order, by ``mapInArrow`` over the sorted blocks:
numpy running sums inside an Arrow batch, and a few numbers carried from batch
to batch. What a block takes over from the blocks before it comes from a
per-block summary (one row per block). Amounts are summed as integers of 1e-9
in two halves, so sums are exact and equal those of the window plan. No value
goes back to its row by a join: a row leaves with its features.

First occurrences of devices come from a grouped min with partial aggregation.
Keys and ids may be of any type with an order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vigil.config import FIRST_TXN_SENTINEL, ROLES
from vigil.operators.features import AMOUNT_TYPE as AMT
from vigil.operators.joins import is_small, kept
from vigil.operators.order import ROWS_PER_BLOCK

HOT_KEY_ROWS = 1_000_000      # a key with more rows than this leaves the hash-window plan
MIN_US = -(1 << 63)
#: an amount in units of 1e-9 is high * 2**HALF + low
HALF = 31


def find_hot_keys(tx: DataFrame, keys, threshold: int = HOT_KEY_ROWS) -> tuple[DataFrame | None, int]:
    """Keys with more than ``threshold`` rows (partial aggregation: a hot key
    costs one partial count per task), None when there are none; and the
    number of rows of all keys."""
    counts = tx.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    most, rows = counts.agg(F.max("_n"), F.sum("_n")).first()
    if rows is None or most <= threshold:
        return None, rows or 0
    return counts.where(F.col("_n") > threshold).select(*keys), rows


def split_hot(tx: DataFrame, hot: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys). A hot key has more than
    ``HOT_KEY_ROWS`` rows, so there are at most rows / HOT_KEY_ROWS of them; the
    list is broadcast below a checked size. Null keys are equal here."""
    right = kept(hot.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]))
    if is_small(right):
        right = F.broadcast(right)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    return tx.join(right, on, "left_anti"), tx.join(right, on, "left_semi")


def _same_as_before(columns: list[pa.Array], last: list | None) -> np.ndarray:
    """Whether each row's key equals the row's before it; ``last``: the key
    before the first row."""
    n = len(columns[0])
    same = np.ones(n, bool)
    for k, col in enumerate(columns):
        before = pa.concat_arrays([pa.array([None if last is None else last[k]], col.type), col.slice(0, n - 1)])
        equal = pc.fill_null(pc.equal(col, before), False)
        both = pc.and_(pc.is_null(col), pc.is_null(before))
        same &= np.asarray(pc.or_(equal, both))
    if last is None and n:
        same[0] = False
    return same


def _sums(values: np.ndarray, first: np.ndarray, carry: int) -> np.ndarray:
    """Running sums that begin anew where ``first`` is true; before the first
    such row they go on from ``carry``."""
    total = np.cumsum(values)
    at = np.maximum.accumulate(np.where(first, np.arange(len(first)), -1))
    base = np.where(at >= 0, (total - values)[at], -carry)
    return total - base


def _last(values: np.ndarray, there: np.ndarray, first: np.ndarray, carry) -> tuple[np.ndarray, np.ndarray]:
    """Value at the latest earlier row of the key where ``there`` holds, and
    whether there is one; ``carry``: (value, known) from before the batch."""
    n = len(values)
    begin = np.maximum.accumulate(np.where(first, np.arange(n), -1))
    at = np.concatenate([[-1], np.maximum.accumulate(np.where(there, np.arange(n), -1))[:-1]])
    inside = (at >= begin) & (at >= 0)
    outside = (begin < 0) & ~inside
    return (np.where(inside, values[np.maximum(at, 0)], carry[0]), inside | (outside & bool(carry[1])))


#: the numbers of an event; ``_n``: 1 where it counts in velocities
NUMBERS = ["_us", "_kind", "_new", "_known", "_n", "_hi", "_lo"]


class _Run:
    """Features of sorted events, batch by batch. ``state``: (key or None,
    {sum: carried}, (last ts, known))."""

    def __init__(self, n_keys: int, windows: int, state=None, marked: bool = False):
        self.n_keys, self.windows = n_keys, windows
        self.names = [f"{c}{j}" for j in range(windows) for c in ("n", "hi", "lo")] + ["devices"]
        self.key, self.sums, self.last = state or (None, dict.fromkeys(self.names, 0), (0, False))
        self.marked = marked  # whether the event before is a new device's marker

    def __call__(self, batch: pa.RecordBatch):
        """(rows that are data, columns of their features). Columns: keys, then
        those of ``NUMBERS``."""
        keys = batch.columns[:self.n_keys]
        us, kind, new, known, count, hi, lo = (np.asarray(c) for c in batch.columns[self.n_keys:self.n_keys + len(NUMBERS)])
        first = ~_same_as_before(keys, self.key)
        data = kind == self.windows + 1
        out, carried = {}, {}
        for j in range(self.windows):
            sign = data.astype(np.int64) - (kind == j)
            for name, value in (("n", sign * count), ("hi", sign * hi), ("lo", sign * lo)):
                run = _sums(value, first, self.sums[f"{name}{j}"])
                carried[f"{name}{j}"] = int(run[-1])
                out[f"{name}{j}"] = (run - value)[data]
        run = _sums(new + known, first, self.sums["devices"])
        carried["devices"] = int(run[-1])
        out["devices"] = run[data]
        value, there = _last(us, data, first, self.last)
        out["prev"], out["has"] = value[data], there[data]
        # a marker carries the id of its row and stands just before it
        out["is_new"] = np.concatenate([[self.marked], new[:-1] > 0])[data]
        self.marked = bool(new[-1] > 0)
        at = np.flatnonzero(data)
        begin = np.flatnonzero(first)
        if len(at) and (not len(begin) or at[-1] >= begin[-1]):
            self.last = (int(us[at[-1]]), True)
        elif len(begin):
            self.last = (0, False)
        self.key, self.sums = [k[len(us) - 1].as_py() for k in keys], carried
        return data, out


def range_features(tx: DataFrame, windows_minutes, keys, markers: DataFrame | None = None,
                   n_blocks: int | None = None) -> DataFrame:
    """``tx``: data rows with keys, _us, transaction_id, amount, device_id and
    any other columns. ``markers``: known (keys..., device_id) pairs for these
    keys, or None. Returns ``tx`` with the recency, velocity and device
    columns. A row with a null amount is in no velocity."""
    keys = list(keys)
    wins = [int(w) for w in windows_minutes]
    tid, dev = ROLES.transaction_id, ROLES.device
    spark, none = tx.sparkSession, F.lit(None)
    n_win, mark = len(wins), len(wins)
    fixed = F.col(ROLES.amount).cast(AMT)
    whole = (fixed * F.lit(10**9).cast("decimal(10,0)")).cast("decimal(38,0)")
    high = F.floor(whole / F.lit(1 << HALF).cast("decimal(10,0)")).cast("long")
    low = (whole - high.cast("decimal(20,0)") * F.lit(1 << HALF).cast("decimal(10,0)")).cast("long")
    base = tx.withColumns({"_hi": F.coalesce(high, F.lit(0)), "_lo": F.coalesce(low, F.lit(0))})
    row = F.struct(*[F.col(c) for c in tx.columns])

    firsts = tx.groupBy(*keys, dev).agg(F.min(F.struct("_us", tid)).alias("_f"))
    starts = None
    if markers is not None:
        on = F.lit(True)
        right = markers.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate([*keys, dev])]).distinct()
        for i, c in enumerate([*keys, dev]):
            on = on & F.col(c).eqNullSafe(F.col(f"_m{i}"))
        firsts = firsts.join(right, on, "left_anti")
        starts = markers.select(*keys, dev).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_kc"))

    def events(df, us, kind, oid, data=None, **numbers):
        given = {"_us": us, "_kind": F.lit(kind), **{f"_{k}": v for k, v in numbers.items()}}
        return df.select(*keys, *[given.get(n, F.lit(0)).cast("long").alias(n) for n in NUMBERS],
                         oid.cast(tx.schema[tid].dataType).alias("_oid"),
                         (data if data is not None else none.cast(T.StructType(tx.schema.fields))).alias("_row"))

    counted = F.col(ROLES.amount).isNotNull()
    halves = {"hi": F.col("_hi"), "lo": F.col("_lo")}
    parts = [events(base, F.col("_us"), mark + 1, F.col(tid), row, n=counted.cast("long"), **halves)]
    parts += [events(base.where(counted), F.col("_us") + w * 60_000_000, j, F.col(tid), n=F.lit(1), **halves) for j, w in enumerate(wins)]
    # a marker has its row's time and id; the sort puts it before the row
    parts.append(events(firsts, F.col("_f._us"), mark, F.col(f"_f.{tid}"), new=F.lit(1)))
    if starts is not None:
        parts.append(events(starts, F.lit(MIN_US), mark, none, known=F.col("_kc")))
    all_events = parts[0]
    for p in parts[1:]:
        all_events = all_events.unionByName(p)
    # at one time expiries come first, then by id each row behind its marker
    late = (F.col("_kind") >= mark).cast("int")
    order = [*keys, "_us", "_late", "_oid", "_kind"]
    all_events = all_events.withColumn("_late", late)
    if not n_blocks:
        rows = tx.count() * (len(wins) + 1)
        n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BLOCK), 1)
    tagged = (all_events.repartitionByRange(n_blocks, *order).sortWithinPartitions(*order)
              .select(*keys, *NUMBERS, "_row", F.spark_partition_id().alias("_blk")).checkpoint(eager=True))
    n_keys = len(keys)
    totals = T.StructType([T.StructField("_blk", T.IntegerType()), T.StructField("opens", T.BooleanType()),
                           *[T.StructField(f"f{i}", tx.schema[k].dataType) for i, k in enumerate(keys)],
                           *[T.StructField(f"k{i}", tx.schema[k].dataType) for i, k in enumerate(keys)],
                           T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("last", T.LongType()),
                           T.StructField("has", T.BooleanType()), T.StructField("marked", T.BooleanType())])

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a block hands on: its last key, that key's sums in the block,
        and whether the block holds more than one key."""
        run, first, block, opens = _Run(n_keys, n_win), None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(batch.num_columns - 1)[0].as_py()
            first = first or [c[0].as_py() for c in batch.columns[:n_keys]]
            opens = opens or not _same_as_before(batch.columns[:n_keys], run.key or first).all()
            run(batch)
        if block is not None:
            values = [block, opens, *first, *run.key, [run.sums[n] for n in run.names], run.last[0], run.last[1], run.marked]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, arrow_totals)], names=totals.fieldNames())

    arrow_totals = [to_arrow_type(f.dataType) for f in totals.fields]
    # one narrow row per block: bounded by the number of blocks
    blocks = tagged.drop("_row").mapInArrow(summary, totals).orderBy("_blk").collect()
    states: dict[int, tuple] = {}
    key, sums, last, marked = None, None, (0, False), False
    for b in blocks:
        own_first, own_last = [b[f"f{i}"] for i in range(n_keys)], [b[f"k{i}"] for i in range(n_keys)]
        if key is not None:
            states[b["_blk"]] = ((key, sums, last), marked)
        names = _Run(n_keys, n_win).names
        goes_on = not b["opens"] and key == own_first and sums is not None
        mine = dict(zip(names, b["sums"]))
        sums = {n: mine[n] + (sums[n] if goes_on else 0) for n in names}
        last = (b["last"], True) if b["has"] else (last if goes_on else (0, False))
        key, marked = own_last, b["marked"]
    carried = spark.sparkContext.broadcast(states)
    feats = [T.StructField("_prev", T.LongType()), T.StructField("_has", T.BooleanType()), T.StructField("_is_new", T.BooleanType()),
             T.StructField("_devices", T.LongType()),
             *[T.StructField(f"_{c}{j}", T.LongType()) for j in range(n_win) for c in ("n", "hi", "lo")]]
    out = T.StructType([T.StructField("_row", T.StructType(tx.schema.fields)), *feats])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if run is None:
                state, was = carried.value.get(batch.column(batch.num_columns - 1)[0].as_py(), (None, False))
                run = _Run(n_keys, n_win, state, was)
            data, f = run(batch)
            cols = [batch.column(batch.num_columns - 2).filter(pa.array(data)), pa.array(f["prev"]), pa.array(f["has"]),
                    pa.array(f["is_new"]), pa.array(f["devices"]),
                    *[pa.array(f[f"{c}{j}"]) for j in range(n_win) for c in ("n", "hi", "lo")]]
            yield pa.RecordBatch.from_arrays(cols, names=out.fieldNames())

    made = tagged.mapInArrow(features, out)
    cols = {"seconds_since_last_txn": F.when(F.col("_has"), (F.col("_row._us") - F.col("_prev")) / F.lit(1e6)).otherwise(F.lit(FIRST_TXN_SENTINEL)),
            "is_new_device": F.col("_is_new").cast("int"), "distinct_device_count_so_far": F.col("_devices").cast("bigint")}
    unit = F.lit(1 << HALF).cast("decimal(10,0)")
    for j, w in enumerate(wins):
        total = F.col(f"_hi{j}").cast("decimal(20,0)") * unit + F.col(f"_lo{j}").cast("decimal(20,0)")
        exact = (total.cast("decimal(28,0)") * F.lit("0.000000001").cast("decimal(9,9)")).cast(AMT)
        cols[f"velocity_count_{w}m"] = F.col(f"_n{j}").cast("bigint")
        cols[f"velocity_amount_{w}m"] = F.greatest(exact.cast("double"), F.lit(0.0))
    return made.select(*[F.col(f"_row.{c}").alias(c) for c in tx.columns], *[c.alias(n) for n, c in cols.items()])
