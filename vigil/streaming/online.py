"""Streaming twin of the causal features.

``transformWithStateInPandas`` keyed by customer keeps, per customer:
  meta     ValueState: the last committed time (T5), the largest one, the number
           of devices seen, and the devices themselves while there are few (T6)
  recent   ValueState: committed transactions inside the largest window, while
           there are few (T2, T3)
  devices  MapState device -> first time, beyond ``FEW_DEVICES``: a batch looks
           up its own devices only, each entry has its own lifetime
  buckets  MapState time bucket -> (rows, amount, chunks), beyond
           ``FEW_EVENTS``: partial sums of a 96th of the largest window
  rows     MapState (bucket, chunk) -> times and amounts of one batch's rows
A busy customer's batch reads the partial sums (about a hundred), and exact
rows only of buckets where a window of the batch begins or ends; it appends
chunks and drops buckets that have left the largest window. Most customers have
few events and devices: two reads and two writes. Both layouts give the same
features.

Two-phase contract per transaction (T1): features are computed from state
that excludes the transaction, then it is committed. Inside a micro-batch a
customer's rows are ordered by (ts, transaction_id) and processed with
vectorised numpy (prefix counts + searchsorted), so a hot customer costs
O(m log m) per batch, not a Python loop per row. Rows with ``ingest`` false
are scored but not committed (T7). An ``initialState`` DataFrame of past
transactions warms the state up (T9). Optional state TTL (T4). Customers and
ids may be of any type; rows without a customer are one customer.

The windows are ``lower < ts <= now`` over committed events, the same
definition as the batch operators, so with chronological arrival the stream
equals the batch features (checked in tests and by the registered query).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigil.config import DEFAULT_WINDOWS_MINUTES, FIRST_TXN_SENTINEL, ROLES
from vigil.functions.columns import micros
from vigil.session import shared_dir

# (column names starting with "_" do not survive the Arrow hand-off)
TS_US = "ts_us"
INPUT_COLS = [ROLES.customer, ROLES.transaction_id, TS_US, ROLES.amount, ROLES.device, "ingest"]


#: a customer with more events in the window, or more devices, has them in maps
FEW_EVENTS, FEW_DEVICES = 512, 128
#: time buckets in the largest window
BUCKETS = 96


def output_schema(windows_minutes, passthrough_ddl: str = "", key_type: str = "long", id_type: str = "long") -> str:
    vel = ", ".join(f"velocity_count_{w}m long, velocity_amount_{w}m double" for w in windows_minutes)
    extra = f", {passthrough_ddl}" if passthrough_ddl else ""
    return (f"{ROLES.customer} {key_type}, {ROLES.transaction_id} {id_type}, {TS_US} long, " + (f"{vel}, " if vel else "")
            + "seconds_since_last_txn double, is_new_device int, distinct_device_count_so_far long" + extra)


# A batch calls the operator once per customer, mostly with a few rows, where
# pandas costs far more than the work; arrays and one DataFrame at the end do it.
def _in_order(t: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions in (ts, id) order."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(t[by_id], kind="stable")]


def _devices(pdf: pd.DataFrame) -> np.ndarray:
    """Devices as objects, an absent one as ""."""
    devs = pdf[ROLES.device].to_numpy(object)
    return np.where(pd.isna(devs), "", devs)


def _flag(pdf: pd.DataFrame, name: str) -> np.ndarray:
    """A flag column; absent flags hold."""
    if name not in pdf:
        return np.ones(len(pdf), bool)
    flags = pdf[name]
    return flags.to_numpy() if flags.dtype == bool else flags.fillna(True).to_numpy(bool)


class OnlineFeatures(StatefulProcessor):
    def __init__(self, windows_minutes=DEFAULT_WINDOWS_MINUTES, ttl_ms: int | None = None,
                 passthrough=(), velocity_ttl_ms: int | None = None, few_events: int = FEW_EVENTS, few_devices: int = FEW_DEVICES):
        self.passthrough = list(passthrough)
        self.windows = [int(w) for w in windows_minutes]
        self.w_us = [w * 60_000_000 for w in self.windows]
        self.max_w = max(self.w_us) if self.w_us else 0
        self.width = max(1, self.max_w // BUCKETS)
        self.few_events, self.few_devices = few_events, few_devices
        self.ttl_ms = ttl_ms
        # events are of no use beyond the largest window; kept twice as long
        self.velocity_ttl_ms = velocity_ttl_ms or (2 * self.max_w // 1000 if ttl_ms and self.max_w else None)

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl, short = self.ttl_ms, self.velocity_ttl_ms
        self.meta = handle.getValueState("meta", "last long, maxnow long, n long, many boolean, devices array<string>", ttl)
        self.recent = handle.getValueState("recent", "busy boolean, us array<long>, amount array<double>", short)
        self.devices = handle.getMapState("devices", "device string", "us long", ttl)
        self.buckets = handle.getMapState("buckets", "bucket long", "n long, total double, chunks int", short)
        self.rows = handle.getMapState("rows", "bucket long, chunk int", "us array<long>, amount array<double>", short)

    # -- events inside the largest window ------------------------------
    def _events(self, wanted: np.ndarray):
        """(sums, us, amount): partial sums of busy customers (bucket -> n,
        total, chunks), and exact rows: all of them, or those of the ``wanted``
        buckets."""
        found = self.recent.get()
        if found is None:
            return None, np.empty(0, np.int64), np.empty(0)
        if not found[0]:
            return None, np.asarray(found[1], np.int64), np.asarray(found[2], np.float64)
        sums = {k[0]: tuple(v) for k, v in self.buckets.iterator()}
        us, amount = [np.empty(0, np.int64)], [np.empty(0)]
        for b in wanted.tolist():
            for chunk in range(sums[b][2] if b in sums else 0):
                part = self.rows.getValue((b, chunk))
                if part is not None:
                    us.append(np.asarray(part[0], np.int64))
                    amount.append(np.asarray(part[1], np.float64))
        return sums, np.concatenate(us), np.concatenate(amount)

    def _add_events(self, sums, us, amount, cutoff: int, old_us, old_amount) -> None:
        """Append committed rows, drop what has left the largest window."""
        if sums is None:
            us, amount = np.append(old_us, us), np.append(old_amount, amount)
            keep = us > cutoff
            us, amount = us[keep], amount[keep]
            if len(us) <= self.few_events:
                self.recent.update((False, us.tolist(), amount.tolist()))
                return
            sums = {}
        gone = [b for b in sums if (b + 1) * self.width <= cutoff + 1]
        for b in gone:
            for chunk in range(sums[b][2]):
                self.rows.removeKey((b, chunk))
            self.buckets.removeKey((b,))
        own = us // self.width
        for b in np.unique(own).tolist():
            if (b + 1) * self.width <= cutoff + 1:
                continue
            at = own == b
            n, total, chunks = sums.get(b, (0, 0.0, 0)) if b not in gone else (0, 0.0, 0)
            self.rows.updateValue((b, chunks), (us[at].tolist(), amount[at].tolist()))
            self.buckets.updateValue((b,), (n + int(at.sum()), float(total + amount[at].sum()), chunks + 1))
        self.recent.update((True, [], []))

    def _clear_events(self) -> None:
        for state in (self.recent, self.buckets, self.rows):
            state.clear()

    @staticmethod
    def _upto(x: np.ndarray, width: int, sums, us: np.ndarray, cum: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State rows and amounts at or before each time: whole buckets before
        the time's own, and the exact rows of that one."""
        at = np.searchsorted(us, x, side="right")
        if sums is None:
            return at, cum[at]
        order = np.array(sorted(sums), np.int64)
        n = np.concatenate([[0], np.cumsum([sums[b][0] for b in order.tolist()])]) if len(order) else np.zeros(1, np.int64)
        total = np.concatenate([[0.0], np.cumsum([sums[b][1] for b in order.tolist()])]) if len(order) else np.zeros(1)
        whole = np.searchsorted(order, x // width)
        begin = np.searchsorted(us, x // width * width, side="left")
        return n[whole] + at - begin, total[whole] + cum[at] - cum[begin]

    # -- devices ---------------------------------------------------------
    def _known_devices(self, meta, wanted) -> set:
        if not meta[3]:
            return set(meta[4])
        return {d for d in wanted if self.devices.containsKey((d,))}

    def _load_meta(self):
        m = self.meta.get()
        return (None, None, 0, False, []) if m is None else (m[0], m[1], m[2], m[3], list(m[4] or []))

    def _commit(self, us, amount, devs, meta, known: set, sums, old_us, old_amount):
        """Fold committed rows (in arrival order) into state."""
        if len(us) == 0:
            return
        _, prev_max, n, many, few = meta
        new_max = int(us.max()) if prev_max is None else max(int(prev_max), int(us.max()))
        if self.max_w:
            self._add_events(sums, us, amount, new_max - self.max_w, old_us, old_amount)
        first = {}
        for d, t in zip(devs, us.tolist()):
            first.setdefault(d, t)
        new = [d for d in first if d not in known]
        few = [*few, *new] if not many else []
        if not many and len(few) > self.few_devices:
            new, few, many = few, [], True
        if many:
            for d in {*new, *(first if self.ttl_ms else ())}:  # a device seen again lives on
                self.devices.updateValue((d,), (first.get(d, int(us[0])),))
        self.meta.update((int(us[-1]), new_max, n + sum(d not in known for d in first), many, few))

    # -- the operator --------------------------------------------------
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield self._process(key, pd.concat(list(rows), ignore_index=True))

    def _process(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        """Features for ``pdf`` (one key's rows) from state, then commit."""
        m = len(pdf)
        t, ids = pdf[TS_US].to_numpy(np.int64), pdf[ROLES.transaction_id].to_numpy()
        order = _in_order(t, ids)
        t, ids = t[order], ids[order]
        a = pdf[ROLES.amount].to_numpy(np.float64)[order]
        devs = _devices(pdf)[order].tolist()
        commit = _flag(pdf, "ingest")[order]

        lower = [t - w for w in self.w_us]
        sums, e_us, e_amt = self._events(np.unique(np.concatenate([t, *lower]) // self.width)) if self.windows else (None, t[:0], a[:0])
        by_time = np.argsort(e_us, kind="mergesort")
        s_us, s_cum = e_us[by_time], np.concatenate([[0.0], np.cumsum(e_amt[by_time])])
        # exclusive prefix counts/sums of committed in-batch rows
        cm = np.concatenate([[0], np.cumsum(commit)])
        ca = np.concatenate([[0.0], np.cumsum(np.where(commit, a, 0.0))])
        idx = np.arange(m)
        customer = np.empty(m, object)
        customer[:] = key[0]
        out = {ROLES.customer: customer, ROLES.transaction_id: ids, TS_US: t}
        if self.windows:
            n_now, sum_now = self._upto(t, self.width, sums, s_us, s_cum)
        for w, low in zip(self.windows, lower):
            n_low, sum_low = self._upto(low, self.width, sums, s_us, s_cum)
            blo = np.minimum(np.searchsorted(t, low, side="right"), idx)
            out[f"velocity_count_{w}m"] = (n_now - n_low + cm[idx] - cm[blo]).astype(np.int64)
            out[f"velocity_amount_{w}m"] = np.maximum(sum_now - sum_low + ca[idx] - ca[blo], 0.0)
        # recency: last committed time before each row
        meta = self._load_meta()
        last0 = meta[0]
        pos = np.where(commit, idx, -1)
        prev_pos = np.concatenate([[-1], np.maximum.accumulate(pos)[:-1]]) if m else pos
        prev_t = np.where(prev_pos >= 0, t[np.maximum(prev_pos, 0)],
                          -1 if last0 is None else last0)
        has_prev = (prev_pos >= 0) | (last0 is not None)
        out["seconds_since_last_txn"] = np.where(has_prev, (t - prev_t) / 1e6, FIRST_TXN_SENTINEL)
        # devices: state set S plus committed in-batch devices before the row
        known = self._known_devices(meta, set(devs))
        n_s = meta[2]
        in_state = np.fromiter((d in known for d in devs), bool, count=m)
        in_batch, met = np.zeros(m, bool), set()
        for i, (d, c) in enumerate(zip(devs, commit.tolist())):
            in_batch[i] = d in met
            if c:
                met.add(d)
        seen = in_state | in_batch
        first_new = commit & ~seen
        new_before = np.cumsum(first_new) - first_new
        out["is_new_device"] = (~seen).astype(np.int32)
        out["distinct_device_count_so_far"] = (n_s + new_before + (~seen)).astype(np.int64)

        self._commit(t[commit], a[commit], [d for d, c in zip(devs, commit.tolist()) if c], meta, known, sums, e_us, e_amt)
        for c in self.passthrough:
            out[c] = pdf[c].to_numpy()[order]
        if "emit" in pdf:  # ingest-only rows (S9) update state but emit nothing
            emit = _flag(pdf, "emit")[order]
            out = {c: v[emit] for c, v in out.items()}
        return pd.DataFrame(out)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Warm-up with past transactions, committed in time order."""
        h = initialState.sort_values([TS_US, ROLES.transaction_id], kind="mergesort")
        devs = _devices(h).tolist()
        meta = self._load_meta()
        sums, e_us, e_amt = self._events(np.empty(0, np.int64))
        self._commit(h[TS_US].to_numpy(np.int64), h[ROLES.amount].to_numpy(np.float64), devs, meta,
                     self._known_devices(meta, set(devs)), sums, e_us, e_amt)

    def close(self) -> None:
        pass


class EventTimeOrderedFeatures(OnlineFeatures):
    """Option ``event_time_order``: rows wait in a buffer until the
    watermark passes them and are then released in (ts, id) order, so any
    arrival order within the watermark delay gives the batch features. An
    event-time timer per key fires when the watermark passes the newest
    buffered row; rows at or before the watermark are processed, the rest
    stay buffered. Another timer drops a customer's events once the watermark
    has passed their largest window."""

    def __init__(self, windows_minutes=DEFAULT_WINDOWS_MINUTES, ttl_ms: int | None = None,
                 passthrough=(), velocity_ttl_ms: int | None = None, passthrough_ddl: str = "", id_type: str = "long"):
        super().__init__(windows_minutes, ttl_ms, passthrough, velocity_ttl_ms)
        own = [c for c in self.passthrough if c not in INPUT_COLS]
        self.waiting = [ROLES.transaction_id, TS_US, ROLES.amount, ROLES.device, "ingest", "emit", *own]
        self.waiting_ddl = (f"{ROLES.transaction_id} {id_type}, {TS_US} long, {ROLES.amount} double, {ROLES.device} string, "
                            "ingest boolean, emit boolean" + (f", {passthrough_ddl}" if passthrough_ddl else ""))

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.pending = handle.getListState("pending", self.waiting_ddl, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        for flag in ("ingest", "emit"):
            pdf[flag] = pdf[flag].fillna(True).astype(bool) if flag in pdf else True
        self.pending.appendList(list(zip(*(pdf[c].tolist() for c in self.waiting))))
        self.handle.registerTimer(int(pdf[TS_US].max() // 1000) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        rows = list(self.pending.get()) if self.pending.exists() else []
        buf = pd.DataFrame(rows, columns=self.waiting)
        ready = buf[buf[TS_US] < wm_us]
        rest = buf[buf[TS_US] >= wm_us]
        if len(rest):
            self.pending.put(list(zip(*(rest[c].tolist() for c in self.waiting))))
            self.handle.registerTimer(int(rest[TS_US].max() // 1000) + 1)
        else:
            self.pending.clear()
        if len(ready):
            yield self._process(key, ready.reset_index(drop=True))
        newest = self._load_meta()[1]
        if newest is not None and self.max_w:
            if newest + self.max_w < wm_us:
                self._clear_events()
            else:
                self.handle.registerTimer((newest + self.max_w) // 1000 + 1)


def prepare(tx: DataFrame, keep=()) -> DataFrame:
    """Canonical transactions -> operator input columns (plus ``keep``:
    pass-through columns and the optional ``emit`` flag)."""
    if TS_US in tx.columns:
        out = tx
    else:
        out = tx.withColumn(TS_US, F.col("_us") if "_us" in tx.columns else micros(ROLES.ts))
    if "ingest" not in out.columns:
        out = out.withColumn("ingest", F.lit(True))
    return out.select(*INPUT_COLS, *keep)


def online_features(stream: DataFrame, windows_minutes=DEFAULT_WINDOWS_MINUTES,
                    initial_state: DataFrame | None = None, ttl_ms: int | None = None,
                    dedup_within_watermark: str | None = None, passthrough=(),
                    event_time_order: str | None = None, velocity_ttl_ms: int | None = None,
                    few_events: int = FEW_EVENTS, few_devices: int = FEW_DEVICES) -> DataFrame:
    """Streaming features keyed by customer. ``dedup_within_watermark``
    (e.g. '1 hour') drops repeated transaction ids (T8; needs a watermark
    on ts, so it applies to streams carrying ``ts``). ``passthrough``
    columns are copied from each input row to its output row. With
    ``ttl_ms`` (last time and devices; the events of the windows have
    ``velocity_ttl_ms``, by default twice the largest window) the operator runs in processing-time mode, which keeps
    scheduling state-cleanup batches without data: run it with a
    processing-time trigger, or disable no-data batches for a bounded
    ``availableNow`` replay. ``event_time_order`` (a watermark delay such
    as '3 days') releases rows in event-time order once the watermark passes
    them; pass-through columns and ``emit`` wait with their row."""
    s = stream
    if dedup_within_watermark:
        # watermarks need a TIMESTAMP column; the session zone is UTC
        s = (s.withColumn("_wts", F.col(ROLES.ts).cast("timestamp"))
              .withWatermark("_wts", dedup_within_watermark)
              .dropDuplicatesWithinWatermark([ROLES.transaction_id]).drop("_wts"))
    out_fixed = (ROLES.customer, ROLES.transaction_id, TS_US)
    passthrough = [c for c in passthrough if c not in out_fixed]
    keep = [c for c in passthrough if c not in INPUT_COLS] + (["emit"] if "emit" in s.columns else [])
    ddl = ", ".join(f"`{c}` {s.schema[c].dataType.simpleString()}" for c in passthrough)
    s = prepare(s, keep=keep)
    types = [s.schema[c].dataType.simpleString() for c in (ROLES.customer, ROLES.transaction_id)]
    init = None
    if initial_state is not None:
        init = prepare(initial_state).groupBy(ROLES.customer)
    if event_time_order:
        s = s.withColumn("ets", F.timestamp_micros(F.col(TS_US))).withWatermark("ets", event_time_order)
        return s.groupBy(ROLES.customer).transformWithStateInPandas(
            statefulProcessor=EventTimeOrderedFeatures(
                windows_minutes, ttl_ms, passthrough, velocity_ttl_ms,
                ", ".join(f"`{c}` {s.schema[c].dataType.simpleString()}" for c in passthrough if c not in INPUT_COLS), types[1]),
            outputStructType=output_schema(windows_minutes, ddl, *types), outputMode="Append",
            timeMode="EventTime", initialState=init)
    time_mode = "ProcessingTime" if ttl_ms else "None"
    return s.groupBy(ROLES.customer).transformWithStateInPandas(
        statefulProcessor=OnlineFeatures(windows_minutes, ttl_ms, passthrough, velocity_ttl_ms, few_events, few_devices),
        outputStructType=output_schema(windows_minutes, ddl, *types), outputMode="Append",
        timeMode=time_mode, initialState=init)


def score_stream(features: DataFrame, maps, model, threshold: float) -> DataFrame:
    """The feature stream joined to the static encoder maps (broadcast
    after a size check) and scored by a fitted Spark ML pipeline; the flag is
    score >= threshold. Scoring happens on state before this row's commit,
    because the feature operator computes features before committing."""
    from vigil.functions.columns import flag
    from vigil.operators.features import apply_risk_maps
    from vigil.operators.models import score
    scored = score(model, apply_risk_maps(features, maps))
    return scored.withColumn("flagged", flag("score", threshold))


def enable_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class state_partitions:
    """Context manager: stateful queries started inside it get one state
    partition per default-parallelism slot (the count is fixed at a query's
    first start and stored in its checkpoint)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.prev = self.spark.conf.get("spark.sql.shuffle.partitions")
        n = max(1, self.spark.sparkContext.defaultParallelism)
        self.spark.conf.set("spark.sql.shuffle.partitions", str(n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.prev)
        return False


def _files(spark: SparkSession, folder: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(path)) if fs.exists(path) else 0


def stage_chunks(df: DataFrame, chunk: F.Column, folder: str, drop=(), files: int = 1, by: str | None = None) -> None:
    """Write ``df`` chunk by chunk in ascending order, each as exactly
    ``files`` files dealt by customer (or ``by``): where a chunk has rows for
    fewer, empty files make up the number. A file source that takes ``files`` at
    a time so reads whole chunks, and no batch mixes two."""
    spark = df.sparkSession
    staged = df.withColumn("_chunk", chunk)
    chunks = [r[0] for r in staged.select("_chunk").distinct().orderBy("_chunk").collect()]
    by = by or (ROLES.customer if ROLES.customer in df.columns else df.columns[0])
    none = staged.limit(0).drop("_chunk", *drop)
    before = _files(spark, folder)
    for c in chunks:  # bounded: one write per chunk value
        (staged.where(F.col("_chunk").eqNullSafe(F.lit(c))).drop("_chunk", *drop)
         .repartition(files, by).write.mode("append").parquet(folder))
        after = _files(spark, folder) if files > 1 else before + 1
        for _ in range(files - (after - before)):
            none.coalesce(1).write.mode("append").parquet(folder)
        before += files


def replay(spark: SparkSession, tx: DataFrame, chunk: F.Column, windows_minutes=DEFAULT_WINDOWS_MINUTES,
           name: str = "replay", initial_state: DataFrame | None = None, passthrough=(),
           model=None, maps=None, threshold: float = 0.5, event_time_order: str | None = None,
           files: int = 1, few_events: int = FEW_EVENTS, few_devices: int = FEW_DEVICES) -> DataFrame:
    """Test/benchmark harness: write ``tx`` chunk by chunk in ascending order,
    ``files`` files each (so the file source sees them in that order), run
    the streaming features over them ``files`` per micro-batch, and return
    the sink's rows as a batch DataFrame. Folders live under the shared
    checkpoint location, a new one per run."""
    enable_state_store(spark)
    base = shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    src, out, ck = f"{base}/source", f"{base}/out", f"{base}/checkpoint"
    keep = [c for c in passthrough if c not in INPUT_COLS] + (["emit"] if "emit" in tx.columns else [])
    stage_chunks(prepare(tx.withColumn("_c", chunk), keep=keep + ["_c"]), F.col("_c"), src, drop=["_c"], files=files)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
    feats = online_features(stream, windows_minutes, initial_state=initial_state, passthrough=passthrough,
                            event_time_order=event_time_order, few_events=few_events, few_devices=few_devices)
    if model is not None:
        feats = score_stream(feats, maps, model, threshold)
    with state_partitions(spark):
        q = (feats.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)
