"""Assertions of split, features, metrics, policy, gate and monitoring on small
frames with results worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.operators import decisions as dc
from vigil.operators import drift as dr
from vigil.operators import features as fe
from vigil.operators import monitoring as mo
from vigil.operators import ranking as rk
from vigil.operators.split import time_split


def toy_transactions(spark):
    """60 rows, one every 37 minutes, seven customers in turn."""
    start = dt.datetime(2025, 5, 1)
    rows = [(i, i % 7, start + dt.timedelta(minutes=37 * i), 3.0 + 1.25 * i, int(i % 20 == 0), 5, "c", "d") for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, ts timestamp, amount double, label int, "
                                     "merchant_id long, merchant_category string, device_id string")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_time_split_is_chronological_and_complete(spark):
    st, info = time_split(toy_transactions(spark), 0.5, 0.25)
    b = st.groupBy("split").agg(F.min("transaction_id").alias("lo"), F.max("transaction_id").alias("hi")).collect()
    assert {r["split"]: (r["lo"], r["hi"]) for r in b} == {"train": (0, 29), "val": (30, 44), "test": (45, 59)}
    assert (info["train_end"], info["val_end"]) == (30, 45)


def test_recency(spark):
    out = {r.transaction_id: r.seconds_since_last_txn for r in fe.add_recency(toy_transactions(spark)).collect()}
    # the first of each customer has the sentinel, the others come every seventh row
    assert out == {i: 1e6 if i < 7 else 7 * 37 * 60.0 for i in range(60)}


def test_velocity(spark):
    # 259 minutes apart: none within the hour, five within the day
    out = fe.add_velocity(toy_transactions(spark), (60, 1440)).collect()
    for r in out:
        before = min(r.transaction_id // 7, 5)
        assert (r.velocity_count_60m, r.velocity_count_1440m) == (0, before)
        assert r.velocity_amount_1440m == pytest.approx(sum(3 + 1.25 * (r.transaction_id - 7 * k) for k in range(1, before + 1)))


def test_class_ratio(spark):
    df = spark.createDataFrame([(0,)] * 24 + [(1,)] * 3, "label int")
    assert rk.class_ratio(df).first()["ratio"] == 8.0


def test_threshold_tuning(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.2, 0)], "score double, label int")
    b = rk.best_threshold(rk.pr_curve(rk.curve(df, "score", "label"))).first()
    # at 0.6: precision 3/4, recall 1
    assert b["best_threshold"] == 0.6 and b["best_f1"] == pytest.approx(6 / 7)


# ---------------------------------------------------------------- policy
def _decide(spark, realized, baseline, drift):
    m = spark.createDataFrame([("m",)], "model string")
    r = spark.createDataFrame([("m", realized["f1"], realized.get("recall"))], "model string, f1 double, recall double") \
        if realized is not None else None
    b = spark.createDataFrame([("m", baseline.get("f1"))], "model string, base_f1 double") if baseline else None
    d = spark.createDataFrame([("m", drift["consecutive_significant_cycles"], drift["n_significant_features"])],
                              "model string, consecutive_significant_cycles long, n_significant_features long") \
        if drift is not None else None
    return dc.retrain_decision(m, "model", r, b, d).first()


def test_policy_stable(spark):
    d = _decide(spark, {"f1": 0.31, "recall": 0.5}, {"f1": 0.33},
                {"consecutive_significant_cycles": 0, "n_significant_features": 1})
    assert d["should_retrain"] is False and d["triggers"] == [] and d["severity"] == "none"


def test_policy_decay_below_floor(spark):
    d = _decide(spark, {"f1": 0.0, "recall": 0.0}, None, None)
    assert d["should_retrain"] and d["triggers"] == ["decay"] and d["severity"] == "critical"
    assert len(d["reasons"]) == 1 and "the floor is" in d["reasons"][0]


def test_policy_relative_drop(spark):
    d = _decide(spark, {"f1": 0.24, "recall": 0.4}, {"f1": 0.60}, None)
    assert d["triggers"] == ["decay"] and any("from 0.6000 to 0.2400, 60.0%" in r for r in d["reasons"])


def test_policy_drift_only(spark):
    d = _decide(spark, {"f1": 0.4, "recall": 0.6}, {"f1": 0.4},
                {"consecutive_significant_cycles": 6, "n_significant_features": 7})
    assert d["should_retrain"] and d["triggers"] == ["drift"] and d["severity"] == "warning"


def test_policy_many_features_in_one_cycle(spark):
    d = _decide(spark, {"f1": 0.4}, {"f1": 0.4}, {"consecutive_significant_cycles": 1, "n_significant_features": 30})
    assert d["should_retrain"] is False


def test_alert_streak_trailing_run(spark):
    h = spark.createDataFrame([("a", 1, True, 9), ("a", 2, True, 8), ("b", 1, True, 3), ("b", 2, False, 1), ("b", 3, True, 7)],
                              "model string, cycle int, drift_alert boolean, n_significant_features int")
    got = {r["model"]: (r["consecutive_significant_cycles"], r["n_significant_features"])
           for r in dc.alert_streak(h, "model", "cycle").collect()}
    assert got == {"a": (2, 8), "b": (1, 7)}


# ---------------------------------------------------------------- gate and registry
def _gate(spark, champ, chall):
    a = spark.createDataFrame([("m", champ)], "model string, pr_auc double")
    b = spark.createDataFrame([("m", chall)], "model string, pr_auc double")
    return dc.promotion_gate(a, b, "model").first()


def test_gate_promotes(spark):
    g = _gate(spark, 0.40, 0.47)
    assert g["promote"] and g["verdict"] == "promote_challenger" and g["gain"] > g["required_margin"]


def test_gate_rejects_regression(spark):
    g = _gate(spark, 0.30, 0.21)
    assert not g["promote"] and g["verdict"] == "keep_champion"


def test_gate_rejects_small_margin(spark):
    assert not _gate(spark, 0.40, 0.401)["promote"]


def test_promote_and_rollback(spark):
    log = spark.createDataFrame([("m", 1, 1, "register"), ("m", 2, 2, "register"), ("m", 1, 3, "promote"),
                                 ("m", 2, 4, "promote")], "model string, version long, seq long, action string")
    st = {r["version"]: r["stage"] for r in dc.current_stages(log).collect()}
    assert st == {1: "Archived", 2: "Production"}
    log2 = log.unionByName(dc.rollback_record(log, "m", 1, 5))
    st = {r["version"]: r["stage"] for r in dc.current_stages(log2).collect()}
    assert st == {1: "Production", 2: "Archived"}


# ---------------------------------------------------------------- monitoring
def _grid(spark, name_shift, rows=1000):
    """Columns x, y, z over an even grid on [0, 1), each moved by its shift."""
    grid = [tuple((i * 7 % rows) / rows + d for d in name_shift) for i in range(rows)]
    return spark.createDataFrame(grid, "x double, y double, z double")


def _scores(spark, low, high, rows=500):
    return spark.createDataFrame([(low + (high - low) * i / rows,) for i in range(rows)], "score double")


def test_drift_cycle_alerts_on_shift(spark):
    ref, cur = _grid(spark, (0, 0, 0)), _grid(spark, (0.9, -0.9, 0.8))
    rec = dr.drift_cycle(dr.feature_drift_report(ref, cur, ["x", "y", "z"]),
                         dr.prediction_drift(_scores(spark, 0.0, 0.3), _scores(spark, 0.5, 0.9))).first()
    assert rec["drift_alert"] and rec["n_significant_features"] == 3
    assert rec["score_status"] == "significant_shift"


def test_drift_cycle_stable(spark):
    ref, cur = _grid(spark, (0, 0, 0)), _grid(spark, (0, 0, 0), rows=600)
    rec = dr.drift_cycle(dr.feature_drift_report(ref, cur, ["x", "y", "z"]), None).first()
    assert rec["drift_alert"] is False and rec["n_significant_features"] == 0


def test_decay_alert(spark):
    # every positive scores below the threshold
    df = spark.createDataFrame([(i, int(i % 4 == 0), 0.1 + 0.001 * i) for i in range(200)], "id long, y int, score double")
    c = mo.decay_cycle(mo.delayed_performance(df, "score", "y", 0.5)).first()
    assert c["decay_alert"] is True and c["f1"] == 0.0
