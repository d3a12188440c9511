"""Registered queries: class weights, SMOTE, Spark ML scoring, train and
retrain flows (rows-only checks except the class weights)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from vigil.config import FLAG_THRESHOLD, FeatureConfig
from vigil.functions.columns import flag
from vigil.operators import models as md
from vigil.operators.joins import stored
from vigil.operators.smote import smote
from vigil.operators.split import in_split, regime_cut, time_split
from vigil.plans.catalog import query
from vigil.plans.feature_pipeline import build_features
from vigil.plans.q_features import RAW_INPUTS, events_tx, profiled_tx
from vigil.plans.sqlparts import SPLIT, TX_EVENTS
from vigil.plans.training import compare_flow, live_signals, retrain_flow, serve, train_flow, with_profile
from vigil.session import shared_dir
from vigil.sources.tables import read_table

CFG = FeatureConfig()


@query("class_weights", f"""
WITH {TX_EVENTS}, {SPLIT},
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM stx WHERE split = 'train')
SELECT 1 AS label, n / (2.0 * p) AS balanced_weight, (n - p) / greatest(p, 1) AS ratio_weight FROM c
UNION ALL
SELECT 0, n / (2.0 * (n - p)), 1.0 FROM c""")
def q_class_weights(spark, sf_dir):
    """Per-class weights on the train split: 'balanced' and the boosting ratio."""
    st, info = time_split(events_tx(spark, sf_dir))
    tr = st.where(in_split(st, info, "train")).select("label")
    b = md.class_weight_column(tr, mode="balanced", out="balanced_weight")
    r = md.class_weight_column(b, mode="ratio", out="ratio_weight")
    return r.groupBy("label").agg(F.first("balanced_weight").alias("balanced_weight"),
                                  F.first("ratio_weight").alias("ratio_weight"))


def _features(spark, sf_dir):
    res = build_features(events_tx(spark, sf_dir), CFG)
    return res.features.checkpoint(eager=True)


@query("smote")
def q_smote(spark, sf_dir):
    """Train split plus synthetic minority rows up to 10% of the majority."""
    f = _features(spark, sf_dir)
    fcols = CFG.feature_columns()
    out, _ = smote(f.where(F.col("split") == "train").select(*fcols, "label"), fcols)
    return out


NEIGHBOUR_LABEL, NEIGHBOUR_K, VECTOR_SIZE = 1, 5, 64


@query("smote_neighbours", f"""
WITH m AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label = {NEIGHBOUR_LABEL}),
d AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.x, b.x) AS d FROM m a JOIN m b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) - 1 AS rank FROM d)
SELECT vec_id, rank, neighbour, round(d, 6) AS distance FROM r WHERE rank < {NEIGHBOUR_K}""")
def q_smote_neighbours(spark, sf_dir):
    """The five nearest of every vector of one class among its class."""
    from vigil.operators import neighbours
    names = [f"x{i}" for i in range(VECTOR_SIZE)]
    rows = read_table(spark, sf_dir, "embeddings").where(F.col("label") == NEIGHBOUR_LABEL).select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    n = rows.count()
    placed = neighbours.indexed(rows, names, n)
    found = neighbours.nearest(placed, names, NEIGHBOUR_K, n)
    ids = placed.select("_mi", "vec_id")
    return (found.join(ids, "_mi").join(ids.select(F.col("_mi").alias("_nn"), F.col("vec_id").alias("neighbour")), "_nn")
            .select("vec_id", F.col("_rank").alias("rank"), "neighbour", F.round(F.sqrt("_d"), 6).alias("distance")))


def _score(spark, sf_dir, kind):
    f = _features(spark, sf_dir)
    fcols = CFG.feature_columns()
    train = md.class_weight_column(f.where(F.col("split") == "train"),
                                   mode="ratio" if kind == "gbt" else "balanced")
    model = md.fit(train, fcols, kind, "weight")
    return md.score(model, f.where(F.col("split") == "test")).select("transaction_id", "score")


@query("score_lr")
def q_score_lr(spark, sf_dir):
    """L2 logistic regression with balanced class weights; test-split scores."""
    return _score(spark, sf_dir, "lr")


@query("score_rf")
def q_score_rf(spark, sf_dir):
    """Random forest (300 trees, depth 12) with balanced weights."""
    return _score(spark, sf_dir, "rf")


@query("score_gbt")
def q_score_gbt(spark, sf_dir):
    """Gradient-boosted trees (400 rounds) with the positive-class ratio weight."""
    return _score(spark, sf_dir, "gbt")


@query("score_batch")
def q_score_batch(spark, sf_dir):
    """Batch scoring of every row with a fitted model, 6-decimal score and
    the threshold flag."""
    f = _features(spark, sf_dir)
    fcols = CFG.feature_columns()
    model = md.fit(md.class_weight_column(f.where(F.col("split") == "train")), fcols, "lr", "weight")
    s = md.score(model, f)
    return s.select("transaction_id", "split", F.round("score", 6).alias("score"),
                    flag("score", FLAG_THRESHOLD).alias("flagged"))


@query("train_flow")
def q_train_flow(spark, sf_dir):
    """The full training flow with boosted trees: test metrics at the
    F1-optimal validation threshold."""
    b = train_flow(events_tx(spark, sf_dir), kind="gbt")
    return b.metrics


#: boosting rounds of the registered flows that fit several models
FLOW_ROUNDS = 30
#: days in one drift cycle of the retrain flow
CYCLE_DAYS = 3
RISK_MODEL = "risk_model"


@query("trained_comparison")
def q_trained_comparison(spark, sf_dir):
    """Three kinds of models on raw and computed inputs, at 0.5 and the last one
    also at its tuned threshold, on the same test rows."""
    cfg = FeatureConfig(raw_inputs=RAW_INPUTS)
    tx = profiled_tx(spark, sf_dir).fillna(0.0, subset=list(RAW_INPUTS))
    return compare_flow(tx, cfg=cfg, params={"gbt": {"maxIter": FLOW_ROUNDS}})


def _registry(spark):
    from vigil.plans.registry import Registry
    return Registry(spark, shared_dir(spark, f"registry-{uuid.uuid4().hex}"))


def live_feeds(tx):
    """Feeds of labelled live rows: the later half as it is, and in a changed
    regime, where amounts are three times as large."""
    live = regime_cut(tx, 0.5).where("regime = 'after'").drop("regime")
    return {"same": live, "changed": live.withColumn("amount", F.col("amount") * 3)}


@query("retrain_flow")
def q_retrain_flow(spark, sf_dir):
    """A boosted champion of the earlier half is registered and served on two
    feeds of the later half. Per feed: drift of the cycles against the stored
    reference and realised F1 -> decision -> where it says so a challenger on
    the newest half, both on its test rows -> gate -> stage of the registry."""
    tx = stored(events_tx(spark, sf_dir), "events")
    old = regime_cut(tx, 0.5).where("regime = 'before'").drop("regime")
    trained = with_profile(train_flow(old, kind="gbt", maxIter=FLOW_ROUNDS))  # both feeds register it
    day = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / CYCLE_DAYS)
    rows = []
    for feed, live in live_feeds(tx).items():
        registry = _registry(spark)
        registry.promote(RISK_MODEL, registry.register(RISK_MODEL, "champion", trained))
        champion = registry.load(RISK_MODEL)
        realized, drift = live_signals(champion, live, RISK_MODEL, day)
        realized, drift = realized.checkpoint(), drift.checkpoint()
        rec = retrain_flow(old.unionByName(live), champion, realized, drift, RISK_MODEL, kind="gbt", registry=registry,
                           maxIter=FLOW_ROUNDS)
        d, g, fp = rec["decision"], rec.get("gate") or {}, rec.get("challenger_fingerprint") or {}
        r, s = realized.first(), drift.first()
        rows.append((feed, r["f1"], rec["champion_metrics"]["f1"], s["consecutive_significant_cycles"],
                     s["n_significant_features"], d["should_retrain"], ",".join(d["triggers"]), d["severity"], rec["action"],
                     g.get("champion_value"), g.get("challenger_value"), g.get("gain"), g.get("promote"),
                     fp.get("n_rows"), fp.get("content_sha256"), registry.current(RISK_MODEL)))
    return spark.createDataFrame(rows, (
        "feed string, f1 double, base_f1 double, consecutive_significant_cycles long, n_significant_features long, "
        "should_retrain boolean, triggers string, severity string, action string, champion_value double, "
        "challenger_value double, gain double, promote boolean, challenger_rows long, challenger_sha256 string, "
        "production_version string"))


def _half(name: str) -> str:
    """The split of the earlier half, under names of its own."""
    return re.sub(r"\b(ranked|stx)\b", rf"{name}_\1", SPLIT.replace("FROM tx", f"FROM {name}"))


@query("model_registry_roundtrip", f"""
WITH {TX_EVENTS}, {SPLIT},
old AS (SELECT * EXCLUDE (i, n) FROM (SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS i, count(*) OVER () AS n FROM tx)
        WHERE i < CAST(floor(n * 0.5::DOUBLE) AS BIGINT)),
{_half("old")},
fits AS (SELECT 'v1' AS version, * FROM old_stx WHERE split = 'train' UNION ALL SELECT 'v2', * FROM stx WHERE split = 'train'),
g AS (SELECT version, avg(label) AS m, count(DISTINCT (customer_id, device_id)) AS d FROM fits GROUP BY version),
r AS (SELECT version, merchant_id, (sum(label) + any_value(g.m) * 20.0) / (count(label) + 20.0) AS risk
      FROM fits JOIN g USING (version) GROUP BY version, merchant_id),
steps AS (SELECT * FROM (VALUES (1, 'promoted first', 'v1', 'Production', NULL), (2, 'promoted second', 'v2', 'Archived', 'Production'),
                                (3, 'rolled back', 'v1', 'Production', 'Archived')) t(step, what, version, v1_stage, v2_stage))
SELECT CAST(step AS BIGINT) AS step, what, version, v1_stage, coalesce(v2_stage, 'Staging') AS v2_stage,
       (SELECT count(*) FROM stx WHERE split = 'test') AS n_rows, CAST(0 AS BIGINT) AS n_unequal, any_value(g.d) AS n_devices,
       count(*) AS n_merchants, round(sum(r.risk), 6) AS merchant_risk_sum, round(any_value(g.m), 9) AS global_mean
FROM steps JOIN g USING (version) JOIN r USING (version) GROUP BY ALL""")
def q_model_registry_roundtrip(spark, sf_dir):
    """Two versions are registered; after each promotion and a rollback the
    bundle in production is read back and serves the test rows. ``n_unequal``:
    rows whose score or flag differs from the version's own in memory."""
    tx = stored(events_tx(spark, sf_dir), "events")
    fitted = {"v1": train_flow(regime_cut(tx, 0.5).where("regime = 'before'").drop("regime"), kind="lr"),
              "v2": train_flow(tx, kind="lr")}
    st, info = time_split(tx)
    test = st.where(in_split(st, info, "test")).drop("split")
    own = {v: serve(b, test).select("transaction_id", F.struct("score", "flagged").alias("own")).checkpoint()
           for v, b in fitted.items()}
    registry, out = _registry(spark), []
    for version, bundle in fitted.items():
        registry.register(RISK_MODEL, version, bundle)
    for step, (what, version) in enumerate([("promoted first", "v1"), ("promoted second", "v2"), ("rolled back", "v1")], 1):
        (registry.rollback if what == "rolled back" else registry.promote)(RISK_MODEL, version)
        served = registry.load(RISK_MODEL)
        stage = {r["version"]: r["stage"] for r in registry.versions(RISK_MODEL).collect()}  # two rows
        same = F.struct("score", "flagged").eqNullSafe(F.col("own"))
        scores = serve(served, test).join(own[version], "transaction_id", "full_outer").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_unequal"))
        risk = served.risk_maps.merchant.agg(F.count(F.lit(1)).alias("n_merchants"),
                                             F.round(F.sum("merchant_risk_score"), 6).alias("merchant_risk_sum"))
        devices = served.known_devices.agg(F.count(F.lit(1)).alias("n_devices"))
        out.append(scores.crossJoin(risk).crossJoin(devices).select(  # one row each
            F.lit(step).cast("long").alias("step"), F.lit(what).alias("what"), F.lit(served.info["version"]).alias("version"),
            F.lit(stage["v1"]).alias("v1_stage"), F.lit(stage["v2"]).alias("v2_stage"), "n_rows", "n_unequal", "n_devices",
            "n_merchants", "merchant_risk_sum", F.round(F.lit(served.risk_maps.global_mean), 9).alias("global_mean")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _tree_attributions(f):
    from vigil.operators.tree_explain import path_attributions
    fcols = CFG.feature_columns()
    model = md.fit(md.class_weight_column(f.where(F.col("split") == "train")), fcols, "rf", "weight")
    return path_attributions(model, f.where(F.col("split") == "test"), fcols, "transaction_id"), fcols


@query("tree_importance")
def q_tree_importance(spark, sf_dir):
    """Mean |path attribution| per feature of the random forest over the
    whole test split, top 15."""
    from vigil.operators.explain import global_importance
    phi, fcols = _tree_attributions(_features(spark, sf_dir))
    return global_importance(phi, fcols)


@query("tree_explanations")
def q_tree_explanations(spark, sf_dir):
    """Per test row, the 8 features with the largest |path attribution|."""
    from vigil.operators.explain import row_explanations
    f = _features(spark, sf_dir)
    phi, fcols = _tree_attributions(f)
    vals = f.where(F.col("split") == "test").select("transaction_id", *fcols)
    return row_explanations(phi.join(vals, "transaction_id"), fcols, "transaction_id")


@query("embedding_classifier")
def q_embedding_classifier(spark, sf_dir):
    """Weighted logistic regression on the embedding vectors (label 0 is the
    positive class): first 70% of ids train, the rest test; exact ranking
    metrics and P/R/F1 at 0.5 on the test rows."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from vigil.operators import ranking as rk
    from vigil.operators.select import keys_at
    emb = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("features"), (F.col("label") == 0).cast("int").alias("label"))
    n = emb.count()
    cut = keys_at(emb, ["vec_id"], [int(n * 0.7)])[int(n * 0.7)][0]
    train = md.class_weight_column(emb.where(F.col("vec_id") < cut))
    total = train.agg(F.sum("weight")).first()[0]
    model = md.build_estimator("lr", "weight", total).fit(train)
    test = model.transform(emb.where(F.col("vec_id") >= cut)).withColumn(
        "score", vector_to_array("probability")[1])
    return rk.evaluate(test, "score", "label", 0.5)
