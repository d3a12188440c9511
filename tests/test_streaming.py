"""Batch/stream parity of the causal features (hand-built toy stream and
the events table replayed in several micro-batches)."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.config import FeatureConfig
from vigil.operators import features as fe
from vigil.streaming.online import replay

W = (10, 60, 1440)
# customer, offset seconds, amount, device: ties on a timestamp, and gaps of exactly ten minutes and one day
TOY = [
    (7, 0, 12.5, "p"), (7, 600, 30.0, "p"), (7, 600, 8.0, "q"), (8, 900, 100.0, "p"),
    (7, 1100, 5.0, "p"), (8, 87300, 40.0, "r"), (8, 87301, 1.0, "p"),
]
# transaction index -> (c10, a10, c60, a60, c1440, a1440, recency, is_new, distinct), hand computed
EXPECTED = {
    0: (0, 0, 0, 0, 0, 0, 1e6, 1, 1), 1: (0, 0, 1, 12.5, 1, 12.5, 600, 0, 1),
    2: (1, 30, 2, 42.5, 2, 42.5, 0, 1, 2), 3: (0, 0, 0, 0, 0, 0, 1e6, 1, 1),
    4: (2, 38, 3, 50.5, 3, 50.5, 500, 0, 2), 5: (0, 0, 0, 0, 0, 0, 86400, 1, 2),
    6: (1, 40, 1, 40, 1, 40, 1, 0, 2),
}
COLS = ["velocity_count_10m", "velocity_amount_10m", "velocity_count_60m", "velocity_amount_60m",
        "velocity_count_1440m", "velocity_amount_1440m", "seconds_since_last_txn", "is_new_device",
        "distinct_device_count_so_far"]


def toy(spark):
    base = pd.Timestamp("2025-03-10 08:00")
    rows = [(i, c, base + pd.Timedelta(seconds=o), a, d, 4, "m", 0) for i, (c, o, a, d) in enumerate(TOY)]
    pdf = pd.DataFrame(rows, columns=["transaction_id", "customer_id", "ts", "amount", "device_id",
                                      "merchant_id", "merchant_category", "label"])
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _check(rows):
    got = {r["transaction_id"]: tuple(r[c] for c in COLS) for r in rows}
    for i, exp in EXPECTED.items():
        assert got[i] == pytest.approx(exp, rel=1e-9, abs=1e-6), (i, got[i], exp)


def test_toy_batch(spark):
    out = fe.causal_features(toy(spark), FeatureConfig(windows_minutes=W))
    _check(out.collect())


def test_toy_stream_one_row_per_batch(spark):
    tx = toy(spark)
    out = replay(spark, tx, F.col("transaction_id"), W, name="toy")
    _check(out.collect())


def test_events_stream_equals_batch(spark):
    from vigil.plans.q_features import events_tx
    tx = events_tx(spark, SF_SMALL)
    stream = replay(spark, tx, F.to_date("ts"), W, name="events").drop("customer_id", "ts_us")
    batch = fe.causal_features(tx, FeatureConfig(windows_minutes=W)).select("transaction_id", *COLS)
    a = stream.toPandas().set_index("transaction_id").sort_index()[COLS]
    b = batch.toPandas().set_index("transaction_id").sort_index()[COLS]
    pd.testing.assert_frame_equal(a.astype(float), b.astype(float), rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("few", [0, 7])
def test_maps_give_the_same_features(spark, few):
    """String and null customers and string ids, events and devices in maps
    from the first row or after a few: equal to batch, restored from warm-up."""
    from vigil.plans.q_features import skewed_tx
    tx = skewed_tx(spark, SF_SMALL)
    batch = fe.causal_features(tx, FeatureConfig(windows_minutes=W))
    want = batch.select("transaction_id", *COLS).toPandas().set_index("transaction_id").sort_index()[COLS].astype(float)
    for cut in (None, "2024-01-10"):
        rows = tx if cut is None else tx.where(F.col("ts") >= cut)
        warm = None if cut is None else tx.where(F.col("ts") < cut)
        out = replay(spark, rows, F.date_trunc("week", "ts"), W, name="maps", initial_state=warm, few_events=few, few_devices=few)
        got = out.toPandas().set_index("transaction_id").sort_index()[COLS].astype(float)
        pd.testing.assert_frame_equal(got, want.loc[got.index], rtol=1e-9, atol=1e-6)
        assert len(got) == rows.count()


class _Map:
    """A map state that counts its calls."""
    def __init__(self):
        self.own, self.calls = {}, 0

    def __getattr__(self, name):
        def call(key=None, value=None):
            self.calls += 1
            if name == "iterator":
                return iter(list(self.own.items()))
            if name == "updateValue":
                self.own[key] = value
            elif name == "removeKey":
                self.own.pop(key, None)
            elif name == "clear":
                self.own.clear()
            else:
                return key in self.own if name == "containsKey" else self.own.get(key)
        return call


class _Value:
    def __init__(self):
        self.own, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.own

    def update(self, value):
        self.calls += 1
        self.own = value

    def clear(self):
        self.own = None


def test_state_calls_stay_bounded():
    """100,000 devices and 60,000 events on one customer: a batch's state calls
    do not grow with either, and buckets that left the window are gone."""
    import types

    import numpy as np

    from vigil.streaming.online import BUCKETS, OnlineFeatures
    op = OnlineFeatures(W)
    op.init(types.SimpleNamespace(getValueState=lambda *a: _Value(), getMapState=lambda *a: _Map()))
    states = (op.meta, op.recent, op.devices, op.buckets, op.rows)
    costs, minute = [], 60_000_000
    for batch in range(100):
        t = np.arange(1000) * (6 * minute // 100) + batch * 60 * minute
        pdf = pd.DataFrame({"customer_id": 1, "transaction_id": np.arange(1000) + batch * 1000, "ts_us": t, "amount": 1.0,
                            "device_id": [f"d{batch}-{i}" for i in range(1000)], "ingest": True})
        before = sum(s.calls for s in states)
        out = op._process((1,), pdf)
        costs.append(sum(s.calls for s in states) - before)
        assert out["distinct_device_count_so_far"].iloc[-1] == 1000 * (batch + 1) and out["is_new_device"].all()
        assert out["velocity_count_1440m"].iloc[-1] == min(1000 * (batch + 1) - 1, 23_999)
    assert max(costs[50:]) <= 1.1 * max(costs[25:50]) and max(costs) < 3000
    assert len(op.devices.own) == 100_000 and len(op.buckets.own) <= BUCKETS + 5
    assert not op.meta.own[4] and not op.recent.own[1]


def test_a_small_batch_of_one_customer_is_cheap():
    """Features of a dozen rows cost little more than the DataFrame that carries
    them, since a batch calls the operator once per customer."""
    import time
    import types

    import numpy as np

    from vigil.streaming.online import OnlineFeatures
    op = OnlineFeatures(W)
    op.init(types.SimpleNamespace(getValueState=lambda *a: _Value(), getMapState=lambda *a: _Map()))
    own, bare = [], []
    for batch in range(200):
        t = (np.arange(13) * 3600 + batch * 604_800) * 1_000_000
        pdf = pd.DataFrame({"customer_id": 1, "transaction_id": np.arange(13) + batch * 13, "ts_us": t, "amount": 1.0,
                            "device_id": [f"d{i % 5}" for i in range(13)], "ingest": True})
        begin = time.perf_counter()
        out = op._process((1,), pdf)
        own.append(time.perf_counter() - begin)
        columns = {c: out[c].to_numpy() for c in out}
        begin = time.perf_counter()
        pd.DataFrame(columns)
        bare.append(time.perf_counter() - begin)
    assert np.median(own) < 5 * np.median(bare), (np.median(own), np.median(bare))


def test_expired_state_is_forgotten(spark):
    """One row per batch and a lifetime far below the time between batches."""
    import uuid
    from vigil.session import shared_dir
    from vigil.streaming.online import enable_state_store, online_features, prepare, stage_chunks
    enable_state_store(spark)
    base = shared_dir(spark, f"expire-{uuid.uuid4().hex[:8]}")
    stage_chunks(prepare(toy(spark)), F.col("transaction_id"), f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        (online_features(stream, W, ttl_ms=1, velocity_ttl_ms=1).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    rows = spark.read.parquet(f"{base}/out").collect()
    assert len(rows) == len(TOY)
    for r in rows:
        assert tuple(r[c] for c in COLS) == (0, 0, 0, 0, 0, 0, 1e6, 1, 1)


def test_chunks_are_whole_batches(spark):
    """Chunks with fewer rows than files still have their number of files."""
    import uuid
    from vigil.session import shared_dir
    from vigil.streaming.online import stage_chunks
    base = shared_dir(spark, f"chunks-{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([(k, c) for c, n in ((0, 1), (1, 9), (2, 2)) for k in range(n)], "k long, c int")
    stage_chunks(df, F.col("c"), f"{base}/src", files=3)
    seen = []
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/src")
    stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted({r.c for r in b.collect()}))).option(
        "checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
    assert seen == [[0], [1], [2]]


def test_initial_state_warm_up(spark):
    """Stream only the second half with the first half as initial state:
    features of the second half equal the full replay."""
    from vigil.plans.q_features import events_tx
    tx = events_tx(spark, SF_SMALL)
    cut = "2024-01-16"
    later = tx.where(F.col("ts") >= cut)
    warm = replay(spark, later, F.to_date("ts"), W, name="warm", initial_state=tx.where(F.col("ts") < cut))
    full = fe.causal_features(tx, FeatureConfig(windows_minutes=W)).where(F.col("ts") >= cut)
    a = warm.toPandas().set_index("transaction_id").sort_index()[COLS]
    b = full.select("transaction_id", *COLS).toPandas().set_index("transaction_id").sort_index()[COLS]
    pd.testing.assert_frame_equal(a.astype(float), b.astype(float), rtol=1e-9, atol=1e-6)


def test_ingest_false_is_not_committed(spark):
    tx = toy(spark).withColumn("ingest", F.col("transaction_id") != 1)
    out = {r["transaction_id"]: r for r in replay(spark, tx, F.col("transaction_id"), W, name="ingest").collect()}
    # row 1 was scored but not committed: row 2, at the same time, sees only row 0
    assert out[1]["velocity_count_60m"] == 1
    assert out[2]["velocity_count_60m"] == 1 and out[2]["seconds_since_last_txn"] == 600


def test_stream_scoring_equals_batch_scoring(spark):
    from vigil.operators import models as md
    from vigil.plans.q_features import events_tx
    tx = events_tx(spark, SF_SMALL)
    cfg = FeatureConfig(windows_minutes=W)
    maps = fe.fit_risk_maps(tx)
    batch = fe.apply_risk_maps(fe.causal_features(tx, cfg), maps)
    fcols = cfg.feature_columns()
    model = md.fit(md.class_weight_column(batch), fcols, "lr", "weight")
    expect = md.score(model, batch).select("transaction_id", "score").toPandas().set_index("transaction_id")
    got = replay(spark, tx, F.date_trunc("week", "ts"), W, name="score",
                 passthrough=["amount", "merchant_id", "merchant_category", "label"], model=model, maps=maps)
    got = got.select("transaction_id", "score", "flagged").toPandas().set_index("transaction_id")
    assert len(got) == len(expect)
    assert ((got["score"] - expect.loc[got.index, "score"]).abs() < 1e-9).all()
    assert (got["flagged"] == (got["score"] >= 0.5).astype(int)).all()


def test_emit_false_rows_update_state_without_output(spark):
    tx = toy(spark).withColumn("emit", F.col("transaction_id") != 1)
    out = {r["transaction_id"]: r for r in replay(spark, tx, F.col("transaction_id"), W, name="emit").collect()}
    assert 1 not in out and len(out) == 6
    assert out[2]["velocity_count_10m"] == 1          # row 1 was still committed


def test_dedup_within_watermark(spark):
    import uuid
    from vigil.session import shared_dir
    from vigil.streaming.online import online_features, enable_state_store
    enable_state_store(spark)
    tx = toy(spark)
    dup = tx.unionByName(tx.where(F.col("transaction_id").isin(1, 6)))
    base = shared_dir(spark, f"dedup-{uuid.uuid4().hex[:8]}")
    dup.coalesce(1).write.parquet(f"{base}/src")
    stream = spark.readStream.schema(dup.schema).parquet(f"{base}/src")
    q = (online_features(stream, W, dedup_within_watermark="1 hour").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    _check(spark.read.parquet(f"{base}/out").collect())


def test_drift_monitor_keeps_one_cycle_per_batch(spark):
    """Against a profile that was saved and read back; a replay of the whole
    stream, as after a lost checkpoint, adds no second cycle."""
    import uuid
    from vigil.operators import drift as dr
    from vigil.plans.q_metrics import scored_events
    from vigil.session import shared_dir
    from vigil.streaming.labels import drift_monitor
    from vigil.streaming.online import stage_chunks
    s = scored_events(spark, SF_SMALL).select("ts", "amount", "merchant_id", "score")
    base = shared_dir(spark, f"monitor-{uuid.uuid4().hex[:8]}")
    stage_chunks(s, F.date_trunc("week", "ts"), f"{base}/src")
    weeks = sorted(r[0] for r in s.select(F.date_trunc("week", "ts")).distinct().collect())
    ref = s.where(F.col("ts") < "2024-01-08")
    dr.fit_profile(ref, ["amount", "merchant_id", "absent"], "score", version="7").save(spark, f"{base}/profiles")
    profile = dr.DriftProfile.load(spark, f"{base}/profiles", "7")
    assert profile == dr.fit_profile(ref, ["amount", "merchant_id"], "score", version="7")
    seen = []
    for run in range(2):
        stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
        drift_monitor(stream, profile, f"{base}/history", f"{base}/ck{run}").awaitTermination()
        h = spark.read.json(f"{base}/history").orderBy("batch_id").collect()
        seen.append([(r["batch_id"], r["n_features_checked"], r["score_psi"], r["drift_alert"]) for r in h])
    assert seen[0] == seen[1] and [r[:2] for r in seen[0]] == [(i, 2) for i in range(len(weeks))]
    # a cycle is what the two frames give
    last = s.where(F.date_trunc("week", "ts") == F.lit(weeks[-1]))
    want = dr.drift_cycle(dr.feature_drift_report(ref, last, ["amount", "merchant_id"]), dr.prediction_drift(ref, last, "score")).first()
    assert seen[0][-1][2:] == (want["score_psi"], want["drift_alert"])


def test_state_ttl_long_enough_keeps_results(spark):
    """With a TTL far longer than the replay, processing-time expiry never
    fires and the features are unchanged (the TTL path is wired)."""
    import uuid
    from vigil.session import shared_dir
    from vigil.streaming.online import enable_state_store, online_features, prepare, stage_chunks
    enable_state_store(spark)
    base = shared_dir(spark, f"ttl-{uuid.uuid4().hex[:8]}")
    stage_chunks(prepare(toy(spark)), F.col("transaction_id"), f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    # processing-time mode schedules state-cleanup batches without data; a
    # bounded replay turns those off so availableNow can finish
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = (online_features(stream, W, ttl_ms=90 * 24 * 3600 * 1000).writeStream.format("parquet")
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    _check(spark.read.parquet(f"{base}/out").collect())


def test_event_time_order_repairs_out_of_order_arrival(spark):
    """Days arrive pairwise swapped (1, 0, 3, 2, ...). In arrival order the
    features differ from batch; released in event-time order behind a
    3-day watermark they equal batch. A far-future row of a dummy customer
    in the last file moves the watermark past the real rows."""
    import datetime as dt
    from vigil.plans.q_features import events_tx
    tx = events_tx(spark, SF_SMALL)
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    arrival = F.when(day % 2 == 0, day + 1).otherwise(day - 1)
    flush = spark.createDataFrame(
        [(-1, -1, None, None, "x", dt.datetime(2030, 1, 1), 0.0, 0)], tx.schema)
    staged = tx.withColumn("_a", arrival).unionByName(flush.withColumn("_a", F.lit(10_000)))
    batch = fe.causal_features(tx, FeatureConfig(windows_minutes=W)).select("transaction_id", *COLS)
    b = batch.toPandas().set_index("transaction_id").sort_index()[COLS].astype(float)
    # one row is counted but not given out; labels wait with their rows
    quiet = int(b.index[5])
    ordered = replay(spark, staged.withColumn("emit", F.col("transaction_id") != quiet), F.col("_a"), W, name="evtime",
                     event_time_order="3 days", passthrough=["label"]).where("transaction_id >= 0")
    a = ordered.toPandas().set_index("transaction_id").sort_index()
    pd.testing.assert_frame_equal(a[COLS].astype(float), b.drop(index=quiet), rtol=1e-9, atol=1e-6)
    want = tx.select("transaction_id", "label").toPandas().set_index("transaction_id")["label"]
    assert (a["label"] == want.loc[a.index]).all()
    plain = replay(spark, staged, F.col("_a"), W, name="arrival").where("transaction_id >= 0")
    p = plain.toPandas().set_index("transaction_id").sort_index()[COLS].astype(float)
    assert not p.equals(b)
