"""Registered queries: delayed labels, decay cycles, drift history, alerts,
retrain decisions, promotion gates, stage resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.config import FLAG_THRESHOLD, MIN_SIGNIFICANT_FEATURES
from vigil.functions.columns import micros
from vigil.operators import decisions as dc
from vigil.operators import drift as dr
from vigil.operators import monitoring as mo
from vigil.operators import ranking as rk
from vigil.plans.catalog import query
from vigil.plans.q_drift import EDGE_DECIMALS, SCORED_SPLIT, scored_split
from vigil.plans.sqlparts import psi_sql
from vigil.sources.tables import read_table

SEGMENT = "merchant_category"
DRIFT_FEATURES = ["amount", "merchant_id", "score_challenger"]


# ------------------------------------------------------------ delayed labels
def document_scores(spark, sf_dir):
    """Score log over documents: a fixed score from the document length."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return d.select("doc_id", "source", ((F.col("n_chars") % 1000).cast("double") / 1000.0).alias("score"))


def label_feed(spark, sf_dir):
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("y"))


DOC_SQL = """
ds AS (SELECT d.doc_id, d.source, CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS score, l.toxic AS y
       FROM documents d JOIN labels l USING (doc_id)),
cm AS (SELECT source, count(*) FILTER (WHERE score >= 0.5 AND y = 1) AS tp,
              count(*) FILTER (WHERE score >= 0.5 AND y = 0) AS fp,
              count(*) FILTER (WHERE score < 0.5 AND y = 1) AS fn, count(*) AS n_samples
       FROM ds GROUP BY source),
rk AS (SELECT source, y, rank() OVER (PARTITION BY source ORDER BY score)
              + (count(*) OVER (PARTITION BY source, score) - 1) / 2.0 AS mr FROM ds),
roc AS (SELECT source, CASE WHEN count(*) FILTER (WHERE y = 1) = 0 OR count(*) FILTER (WHERE y = 0) = 0 THEN NULL
                       ELSE (sum(mr) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1)
                             * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                            / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) END AS roc_auc
        FROM rk GROUP BY source),
pm AS (SELECT source, n_samples, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM cm),
perf AS (SELECT pm.source, p AS precision, r AS recall,
                CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1, roc.roc_auc, n_samples
         FROM pm JOIN roc USING (source))"""


def _perf(spark, sf_dir):
    j = mo.join_delayed_labels(document_scores(spark, sf_dir), label_feed(spark, sf_dir), "doc_id")
    return mo.delayed_performance(j, "score", "y", FLAG_THRESHOLD, groups=["source"])


def _r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query("delayed_performance", f"""
WITH {DOC_SQL}
SELECT source, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       round(roc_auc, 6) AS roc_auc, n_samples, 0.5::DOUBLE AS threshold FROM perf""")
def q_delayed_performance(spark, sf_dir):
    """Score log joined to late labels; realised metrics per source batch."""
    p = _perf(spark, sf_dir)
    return p.select("source", *_r6("precision", "recall", "f1", "roc_auc"), "n_samples", "threshold")


@query("decay_cycle", f"""
WITH {DOC_SQL}
SELECT source, round(f1, 6) AS f1, round(recall, 6) AS recall, f1 < 0.05 OR recall < 0.30 AS decay_alert FROM perf""")
def q_decay_cycle(spark, sf_dir):
    c = mo.decay_cycle(_perf(spark, sf_dir))
    return c.select("source", *_r6("f1", "recall"), "decay_alert")


# ------------------------------------------------------------ drift history
def segment_history(spark, sf_dir):
    """Daily drift cycles per merchant-category segment against the train
    split: feature PSI for three inputs plus score PSI, one row per
    (segment, day)."""
    ref, _, st = scored_split(spark, sf_dir)
    cur = st.withColumn("day", F.to_date("ts"))
    groups = [SEGMENT, "day"]
    profile = dr.fit_profile(ref, DRIFT_FEATURES, "score", edge_decimals=EDGE_DECIMALS)
    return dr.profile_cycle(profile, cur, groups)


HIST_SQL = f"""
r0 AS (SELECT * FROM stx WHERE split = 'train'),
c0 AS (SELECT *, merchant_category || '|' || strftime(ts, '%Y-%m-%d') AS ck FROM stx),
{psi_sql('r0', 'c0', DRIFT_FEATURES, group_col='ck', prefix='f_')},
{psi_sql('r0', 'c0', ['score'], group_col='ck', prefix='s_')},
fsum AS (SELECT ck, count(*) FILTER (WHERE psi >= 0.25) AS n_significant_features FROM f_psi GROUP BY ck),
hist AS (SELECT split_part(f.ck, '|', 1) AS merchant_category, CAST(split_part(f.ck, '|', 2) AS DATE) AS day,
                f.n_significant_features, round(s.psi, 4) AS score_psi,
                f.n_significant_features >= 3 OR s.psi >= 0.25 AS drift_alert
         FROM fsum f JOIN s_psi s USING (ck))"""


@query("segment_drift_history", f"""
WITH {SCORED_SPLIT}, {HIST_SQL}
SELECT * FROM hist""")
def q_segment_drift_history(spark, sf_dir):
    h = segment_history(spark, sf_dir)
    return h.select(SEGMENT, "day", "n_significant_features", "score_psi", "drift_alert")


STREAK_SQL = """
brk AS (SELECT *, sum(CASE WHEN drift_alert THEN 0 ELSE 1 END)
                   OVER (PARTITION BY merchant_category ORDER BY day DESC ROWS UNBOUNDED PRECEDING) AS breaks,
               row_number() OVER (PARTITION BY merchant_category ORDER BY day DESC) AS rn
        FROM hist),
streak AS (SELECT merchant_category, count(*) FILTER (WHERE breaks = 0) AS consecutive_significant_cycles,
                  max(n_significant_features) FILTER (WHERE rn = 1) AS n_significant_features
           FROM brk GROUP BY merchant_category)"""


@query("alert_streak", f"""
WITH {SCORED_SPLIT}, {HIST_SQL}, {STREAK_SQL}
SELECT * FROM streak""")
def q_alert_streak(spark, sf_dir):
    return dc.alert_streak(segment_history(spark, sf_dir), SEGMENT, "day")


@query("alerts", f"""
WITH {DOC_SQL}, {SCORED_SPLIT}, {HIST_SQL}
SELECT 'decay' AS alert_type, 'critical' AS severity, source AS subject,
       'Labelled performance too low: ' || concat_ws(', ',
           CASE WHEN f1 < 0.05 THEN printf('F1 %.4f (at least 0.05)', f1) END,
           CASE WHEN recall < 0.30 THEN printf('recall %.4f (at least 0.3)', recall) END) AS message
FROM perf WHERE f1 < 0.05 OR recall < 0.30
UNION ALL
SELECT 'drift', 'warning', merchant_category || '|' || CAST(day AS VARCHAR),
       'Drift alert: ' || concat_ws(', ',
           CASE WHEN n_significant_features >= 3 THEN printf('%d shifted features (limit 3)', n_significant_features) END,
           CASE WHEN score_psi >= 0.25 THEN 'shifted scores (PSI ' || CAST(score_psi AS VARCHAR) || ')' END)
FROM hist WHERE drift_alert""")
def q_alerts(spark, sf_dir):
    """Typed alerts table: decay (critical) per source batch, drift
    (warning) per segment-day cycle."""
    decay = mo.decay_alerts(mo.decay_cycle(_perf(spark, sf_dir)), "source")
    h = segment_history(spark, sf_dir).withColumn(
        "cycle", F.concat_ws("|", F.col(SEGMENT), F.col("day").cast("string")))
    drift = mo.drift_alerts(h, "cycle", MIN_SIGNIFICANT_FEATURES)
    return decay.unionByName(drift).select("alert_type", "severity", "subject", "message")


# ------------------------------------------------------------ decisions
def segment_metrics(st, split, score="score"):
    """Realised precision/recall/F1 per segment at the flag threshold (one
    grouped count pass; the policy needs no ranking curve)."""
    part = st.where(F.col("split") == split)
    return rk.confusion(part, score, "label", FLAG_THRESHOLD, [SEGMENT]).select(SEGMENT, *rk.prf_columns())


SEG_PERF_SQL = """
segperf AS (
  SELECT split, merchant_category,
         count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
         count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
         count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn
  FROM stx GROUP BY split, merchant_category),
segprf AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
                     CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM segperf),
segf1 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM segprf)"""


@query("retrain_decision", f"""
WITH {SCORED_SPLIT}, {HIST_SQL}, {STREAK_SQL}, {SEG_PERF_SQL},
inp AS (SELECT t.merchant_category, t.f1, v.f1 AS base_f1, s.consecutive_significant_cycles AS cyc,
               s.n_significant_features AS nf
        FROM (SELECT * FROM segf1 WHERE split = 'test') t
        LEFT JOIN (SELECT * FROM segf1 WHERE split = 'val') v USING (merchant_category)
        LEFT JOIN streak s USING (merchant_category)),
flags AS (SELECT *, f1 < 0.05 AS below,
                 base_f1 IS NOT NULL AND base_f1 <> 0 AND (base_f1 - f1) / base_f1 > 0.25 AS dropped,
                 coalesce(cyc, 0) >= 2 AND coalesce(nf, 0) >= 3 AS drifted FROM inp)
SELECT merchant_category, below OR dropped OR drifted AS should_retrain,
       CASE WHEN below OR dropped THEN 'critical' WHEN drifted THEN 'warning' ELSE 'none' END AS severity,
       concat_ws(',', CASE WHEN below OR dropped THEN 'decay' END, CASE WHEN drifted THEN 'drift' END) AS triggers,
       CASE WHEN below OR dropped OR drifted THEN concat_ws('; ',
           CASE WHEN below THEN printf('F1 on labelled rows is %.4f, the floor is 0.05', f1) END,
           CASE WHEN dropped THEN printf('F1 on labelled rows fell from %.4f to %.4f, %.1f%% where 25%% is allowed',
                                         base_f1, f1, (base_f1 - f1) / base_f1 * 100) END,
           CASE WHEN drifted THEN printf('%d features drifted and %d cycles alerted in a row (limits: 3 and 2)',
                                         nf, cyc) END)
       ELSE 'no signal is outside its limits' END AS reasons
FROM flags""")
def q_retrain_decision(spark, sf_dir):
    """Per segment: realised F1 on test vs the val baseline, plus the
    sustained-drift summary of the daily history."""
    _, _, st = scored_split(spark, sf_dir)
    realized = segment_metrics(st, "test").select(SEGMENT, "f1", "recall")
    baseline = segment_metrics(st, "val").select(SEGMENT, F.col("f1").alias("base_f1"))
    drift = dc.alert_streak(segment_history(spark, sf_dir), SEGMENT, "day")
    models = st.where(F.col("split") == "test").select(SEGMENT)
    d = dc.retrain_decision(models, SEGMENT, realized, baseline, drift)
    return d.select(SEGMENT, "should_retrain", "severity", F.array_join("triggers", ",").alias("triggers"),
                    F.array_join("reasons", "; ").alias("reasons"))


@query("promotion_gate", f"""
WITH {SCORED_SPLIT},
t AS (SELECT merchant_category, score, score_challenger, label FROM stx WHERE split = 'test'),
{{ap}}
SELECT a.merchant_category, 'pr_auc' AS metric, round(a.ap, 6) AS champion_value, round(b.ap, 6) AS challenger_value,
       round(b.ap - a.ap, 6) AS gain, 0.005::DOUBLE AS required_margin, b.ap - a.ap >= 0.005 AS promote,
       CASE WHEN b.ap - a.ap >= 0.005 THEN 'promote_challenger' ELSE 'keep_champion' END AS verdict
FROM ap_champ a JOIN ap_chall b USING (merchant_category)""".replace("{ap}", """
c1 AS (SELECT merchant_category, score AS s, sum(label) AS pos, count(*) AS n FROM t GROUP BY ALL),
k1 AS (SELECT *, sum(pos) OVER (PARTITION BY merchant_category ORDER BY s DESC) AS tp,
              sum(n) OVER (PARTITION BY merchant_category ORDER BY s DESC) AS k,
              sum(pos) OVER (PARTITION BY merchant_category) AS p FROM c1),
ap_champ AS (SELECT merchant_category, coalesce(sum(CASE WHEN p > 0 THEN pos * 1.0 / p * tp / k END), 0.0) AS ap FROM k1 GROUP BY ALL),
c2 AS (SELECT merchant_category, score_challenger AS s, sum(label) AS pos, count(*) AS n FROM t GROUP BY ALL),
k2 AS (SELECT *, sum(pos) OVER (PARTITION BY merchant_category ORDER BY s DESC) AS tp,
              sum(n) OVER (PARTITION BY merchant_category ORDER BY s DESC) AS k,
              sum(pos) OVER (PARTITION BY merchant_category) AS p FROM c2),
ap_chall AS (SELECT merchant_category, coalesce(sum(CASE WHEN p > 0 THEN pos * 1.0 / p * tp / k END), 0.0) AS ap FROM k2 GROUP BY ALL)"""))
def q_promotion_gate(spark, sf_dir):
    """Per segment: champion (score) vs challenger (score_challenger) on the
    same held-out test rows, gated on the PR-AUC gain."""
    _, _, st = scored_split(spark, sf_dir)
    test = st.where(F.col("split") == "test")
    champ = rk.ranking_summary(rk.curve(test, "score", "label", [SEGMENT]), [SEGMENT])
    chall = rk.ranking_summary(rk.curve(test, "score_challenger", "label", [SEGMENT]), [SEGMENT])
    champ = champ.withColumn("pr_auc", F.coalesce("pr_auc", F.lit(0.0)))
    chall = chall.withColumn("pr_auc", F.coalesce("pr_auc", F.lit(0.0)))
    return dc.promotion_gate(champ, chall, SEGMENT)


def stage_log(spark, sf_dir):
    """Stage-change log over orders: model = order priority, version =
    order key, finished orders promote their version, others register it."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("model"), F.col("o_orderkey").alias("version"),
        F.struct(micros("o_orderdate").alias("us"), F.col("o_orderkey").alias("key")).alias("seq"),
        F.when(F.col("o_orderstatus") == "F", "promote").otherwise("register").alias("action"))


@query("current_stage", """
WITH lg AS (SELECT o_orderpriority AS model, o_orderkey AS version, o_orderdate AS ts,
                   CASE WHEN o_orderstatus = 'F' THEN 'promote' ELSE 'register' END AS action FROM orders),
prod AS (SELECT model, version FROM (
           SELECT model, version, row_number() OVER (PARTITION BY model ORDER BY ts DESC, version DESC) AS rn
           FROM lg WHERE action = 'promote') WHERE rn = 1)
SELECT l.model, l.version,
       CASE WHEN p.version IS NOT NULL THEN 'Production'
            WHEN bool_or(l.action = 'promote') THEN 'Archived' ELSE 'Staging' END AS stage
FROM lg l LEFT JOIN prod p ON p.model = l.model AND p.version = l.version
GROUP BY l.model, l.version, p.version""")
def q_current_stage(spark, sf_dir):
    return dc.current_stages(stage_log(spark, sf_dir))


@query("champion_challenger", f"""
WITH {SCORED_SPLIT},
t AS (SELECT * FROM stx WHERE split = 'test'),
st AS (SELECT 'champion' AS model, score, label FROM t UNION ALL
       SELECT 'challenger', score_challenger, label FROM t),
r AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
             + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS mr FROM st)
SELECT model, round((sum(mr) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
                     * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                    / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS roc_auc,
       count(*) AS n_samples
FROM r GROUP BY model""")
def q_champion_challenger(spark, sf_dir):
    """Both models scored on the identical held-out rows (one frame, two
    score columns, no join)."""
    _, _, st = scored_split(spark, sf_dir)
    test = st.where(F.col("split") == "test")
    both = test.select(F.lit("champion").alias("model"), "score", "label").unionByName(
        test.select(F.lit("challenger").alias("model"), F.col("score_challenger").alias("score"), "label"))
    ev = rk.evaluate(both, "score", "label", FLAG_THRESHOLD, groups=["model"])
    return ev.select("model", F.round("roc_auc", 6).alias("roc_auc"), "n_samples")
