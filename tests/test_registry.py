"""Bundles by stage, the unforced retrain flow, raw inputs and string ids."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.config import DECAY_F1_ABS_FLOOR, DECAY_F1_RELATIVE_DROP, FeatureConfig, PROMOTION_MIN_GAIN
from vigil.plans import q_features, q_models
from vigil.plans.catalog import ORACLE
from vigil.plans.registry import Registry
from vigil.plans.training import serve, train_flow
from vigil.session import shared_dir
from vigil.sources.adapters import MissingColumnsError, to_transactions


@pytest.fixture(scope="module")
def bundle(spark):
    return train_flow(q_features.events_tx(spark, SF_SMALL), kind="lr", maxIter=10)


def test_a_bundle_comes_back_whole_and_only_once_registered(spark, bundle):
    reg = Registry(spark, shared_dir(spark, f"reg-{uuid.uuid4().hex[:8]}"))
    assert reg.current("m") is None and reg.versions("m").count() == 0
    with pytest.raises(LookupError):
        reg.load("m")
    with pytest.raises(ValueError):
        reg.register("m/..", "1", bundle)
    # a run that failed before it registered leaves files that nobody reads
    bundle.model.write().save(f"{reg.root}/bundles/model=m/version=1/pipeline")
    assert reg.current("m", "Staging") is None
    with pytest.raises(LookupError):
        reg.promote("m", "1")
    reg.register("m", "1", bundle)
    with pytest.raises(ValueError):
        reg.register("m", "1", bundle)
    assert (reg.current("m"), reg.current("m", "Staging")) == (None, "1")
    reg.promote("m", "1")
    got = reg.load("m")
    assert got.feature_cols == bundle.feature_cols and got.threshold_info == bundle.threshold_info
    assert got.metrics.collect() == bundle.metrics.collect() and got.cfg == bundle.cfg
    assert got.known_devices.count() == bundle.known_devices.count() and set(got.profile.edges) == {*bundle.feature_cols, "score"}
    tx = q_features.events_tx(spark, SF_SMALL)
    one, two = ({r.transaction_id: (r.score, r.flagged) for r in serve(b, tx).collect()} for b in (bundle, got))
    assert one == two and len(one) == tx.count()
    row = reg.versions("m").collect()
    assert [(r.version, r.stage) for r in row] == [("1", "Production")]
    assert row[0].f1 == pytest.approx(bundle.metrics.first()["f1"])


def test_retrain_flow_follows_its_signals(spark):
    rows = {r.feed: r for r in q_models.q_retrain_flow(spark, SF_SMALL).collect()}
    assert {r.action == "no_retrain" for r in rows.values()} == {True, False}
    for r in rows.values():
        decay = r.f1 < DECAY_F1_ABS_FLOOR or (r.base_f1 and (r.base_f1 - r.f1) / r.base_f1 > DECAY_F1_RELATIVE_DROP)
        drift = r.consecutive_significant_cycles >= 2 and r.n_significant_features >= 3
        assert r.triggers == ",".join([*(["decay"] if decay else []), *(["drift"] if drift else [])])
        assert r.should_retrain == bool(decay or drift)
        assert r.severity == ("critical" if decay else "warning" if drift else "none")
        if not r.should_retrain:
            assert (r.action, r.production_version, r.challenger_rows) == ("no_retrain", "champion", None)
            continue
        assert r.gain == pytest.approx(r.challenger_value - r.champion_value, abs=2e-6)
        assert r.promote == (r.gain >= PROMOTION_MIN_GAIN)
        assert r.action == ("promoted_challenger" if r.promote else "rejected_challenger")
        assert r.production_version == (r.challenger_sha256[:16] if r.promote else "champion")


def test_raw_inputs_lead_and_pass_the_plan_of_hot_keys(spark):
    from vigil.testing import compare, duckdb_connection
    cols = FeatureConfig(raw_inputs=q_features.RAW_INPUTS).feature_columns()
    assert cols[:29] == [*q_features.RAW_INPUTS, "amount"] and len(cols) == 40
    out = q_features.q_feature_matrix_raw_inputs(spark, SF_SMALL, hot_key_rows=-1)
    r = compare(out, duckdb_connection(SF_SMALL), ORACLE["feature_matrix_raw_inputs"])
    assert r["columns_match"] and r["value_mismatches"] == 0 and r["spark_rows"] == r["oracle_rows"]


def test_adapters_keep_string_ids_and_named_inputs(spark):
    df = spark.createDataFrame([("t-1", "c 1", None, 2, "x")], "t string, c string, m string, v int, helper string")
    mapping = {"transaction_id": "t", "customer_id": "c", "merchant_id": "m", "amount": F.lit(1)}
    out = to_transactions(df, mapping, keep=["v"])
    kinds = dict(out.dtypes)
    assert [kinds[c] for c in ("transaction_id", "customer_id", "merchant_id", "v", "amount")] == ["string"] * 3 + ["double"] * 2
    assert "helper" not in kinds and out.first()["customer_id"] == "c 1"
    with pytest.raises(MissingColumnsError):
        to_transactions(df, mapping, keep=["v", "w"])


def _is_kept(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "LogicalRDD" in plan and "UDF" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_the_drift_reference_scores_its_rows_once(spark, bundle, monkeypatch):
    """The exact edges read the training rows several times."""
    from vigil.plans import training
    seen, fit = [], training.fit_profile
    monkeypatch.setattr(training, "fit_profile", lambda train, *a: seen.append(train) or fit(train, *a))
    training.with_profile(bundle)
    assert len(seen) == 1 and _is_kept(seen[0])
    assert seen[0].count() == bundle.features.where("split = 'train'").count()


def test_both_feeds_register_one_drift_reference(spark, bundle, monkeypatch):
    from vigil.operators import decisions
    from vigil.plans import training
    fitted, histories, fit, streak = [], [], training.fit_profile, decisions.alert_streak
    monkeypatch.setattr(training, "fit_profile", lambda *a: fitted.append(1) or fit(*a))
    monkeypatch.setattr(decisions, "alert_streak", lambda h, *a: histories.append(h) or streak(h, *a))
    monkeypatch.setattr(q_models, "train_flow", lambda *a, **k: bundle)
    monkeypatch.setattr(q_models, "retrain_flow", lambda *a, **k: {
        "decision": {"should_retrain": False, "triggers": [], "severity": "none"}, "champion_metrics": {"f1": 0.0}, "action": "no_retrain"})
    assert q_models.q_retrain_flow(spark, SF_SMALL).count() == 2
    assert len(fitted) == 1 and len(histories) == 2 and all(map(_is_kept, histories))


def test_bins_are_found_in_a_literal_array(spark):
    """One comparison for each halving, not one for each edge of each feature."""
    import math

    import numpy as np
    from vigil.operators.drift import _binned
    values = [-math.inf, -1.0, 0.0, 0.5, 1.0, 2.5, 9.0, math.inf, math.nan, None]
    edges = {f"f{i}": sorted(e) for i, e in enumerate([[0.0, 1.0, 2.0], [0.5] * 9, [], [-math.inf, 1.0, math.inf], *[[*map(float, range(9))]] * 9])}
    df = spark.createDataFrame([(k, *[v] * len(edges)) for k, v in enumerate(values)], ", ".join(["k int", *[f"{f} double" for f in edges]]))
    out = _binned(df, edges, ["k"])
    known = [(k, v) for k, v in enumerate(values) if v is not None and not math.isnan(v)]
    assert {(r.k, r.feature): r.bin for r in out.collect()} == {
        (k, f): int(np.searchsorted(es, v, side="right")) for k, v in known for f, es in edges.items()}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") < sum(map(len, edges.values()))
