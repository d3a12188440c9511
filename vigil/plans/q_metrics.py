"""Registered queries: scoring flags, ranking metrics, thresholds, model table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.config import FLAG_THRESHOLD
from vigil.functions.columns import flag
from vigil.operators import ranking as rk
from vigil.plans.catalog import query
from vigil.plans.q_features import events_tx
from vigil.plans.sqlparts import TX_EVENTS

# Fixed score expressions over the events transactions, on an integer grid so
# Spark and DuckDB produce identical doubles (and real score ties).
SCORED = TX_EVENTS + r""",
scored AS (
  SELECT *,
         CAST(least(CAST(floor(amount) AS BIGINT), 499) * 2 + (merchant_id * 37) % 100 AS DOUBLE) / 1100.0 AS score,
         CAST((merchant_id * 53 + CAST(floor(amount) AS BIGINT)) % 1000 AS DOUBLE) / 1000.0 AS score_challenger
  FROM tx
)"""


def scored_events(spark, sf_dir):
    tx = events_tx(spark, sf_dir)
    a = F.floor("amount").cast("bigint")
    champ = (F.least(a, F.lit(499)) * 2 + (F.col("merchant_id") * 37) % 100).cast("double") / 1100.0
    chall = ((F.col("merchant_id") * 53 + a) % 1000).cast("double") / 1000.0
    return tx.withColumns({"score": champ, "score_challenger": chall})


def stacked_scores(spark, sf_dir):
    """(model, transaction_id, score, label) for both fixed models."""
    s = scored_events(spark, sf_dir)
    champ = s.select(F.lit("champion").alias("model"), "transaction_id", "score", "label")
    chall = s.select(F.lit("challenger").alias("model"), "transaction_id",
                     F.col("score_challenger").alias("score"), "label")
    return champ.unionByName(chall)


STACKED = SCORED + r""",
stacked AS (
  SELECT 'champion' AS model, transaction_id, score, label FROM scored
  UNION ALL
  SELECT 'challenger' AS model, transaction_id, score_challenger AS score, label FROM scored
)"""


def _r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query("flag_scores", f"""
WITH {SCORED}
SELECT transaction_id, score, CAST(score >= 0.5 AS INTEGER) AS flagged FROM scored""")
def q_flag_scores(spark, sf_dir):
    s = scored_events(spark, sf_dir)
    return s.select("transaction_id", "score", flag("score", FLAG_THRESHOLD).alias("flagged"))


@query("class_ratio", f"""
WITH {TX_EVENTS}
SELECT count(*) FILTER (WHERE label = 1) AS n_positive, count(*) FILTER (WHERE label = 0) AS n_negative,
       round(count(*) FILTER (WHERE label = 0) / greatest(count(*) FILTER (WHERE label = 1), 1), 6) AS ratio
FROM tx""")
def q_class_ratio(spark, sf_dir):
    r = rk.class_ratio(events_tx(spark, sf_dir))
    return r.select("n_positive", "n_negative", F.round("ratio", 6).alias("ratio"))


@query("confusion", f"""
WITH {SCORED}
SELECT count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn,
       count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
       count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
       count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
       count(*) AS n_samples, count(*) FILTER (WHERE label = 1) AS n_positive
FROM scored""")
def q_confusion(spark, sf_dir):
    return rk.confusion(scored_events(spark, sf_dir), "score", "label", FLAG_THRESHOLD)


@query("prf", f"""
WITH {SCORED},
c AS (SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
             count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM scored),
m AS (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM c)
SELECT round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM m""")
def q_prf(spark, sf_dir):
    cm = rk.confusion(scored_events(spark, sf_dir), "score", "label", FLAG_THRESHOLD)
    return cm.select(*rk.prf_columns()).select(*_r6("precision", "recall", "f1"))


@query("roc_auc", f"""
WITH {SCORED},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mr FROM scored),
t AS (SELECT sum(mr) FILTER (WHERE label = 1) AS sp, count(*) FILTER (WHERE label = 1) AS p,
             count(*) FILTER (WHERE label = 0) AS n FROM r)
SELECT round((sp - p * (p + 1) / 2.0) / (p * n), 6) AS roc_auc FROM t""")
def q_roc_auc(spark, sf_dir):
    cv = rk.curve(scored_events(spark, sf_dir), "score", "label")
    return rk.ranking_summary(cv).select(*_r6("roc_auc"))


_AP_SQL = """
th AS (SELECT DISTINCT score AS t FROM {src}),
pts AS (SELECT t,
               (SELECT count(*) FROM {src} s WHERE s.score >= th.t AND s.label = 1) AS tp,
               (SELECT count(*) FROM {src} s WHERE s.score >= th.t) AS k,
               (SELECT count(*) FROM {src} s WHERE s.score = th.t AND s.label = 1) AS pos_here
        FROM th),
tot AS (SELECT count(*) FILTER (WHERE label = 1) AS p FROM {src})"""


@query("average_precision", f"""
WITH {SCORED}, {_AP_SQL.format(src='scored')}
SELECT round(sum(pos_here * 1.0 / (SELECT p FROM tot) * tp / k), 6) AS pr_auc FROM pts""")
def q_average_precision(spark, sf_dir):
    cv = rk.curve(scored_events(spark, sf_dir), "score", "label")
    return rk.ranking_summary(cv).select(*_r6("pr_auc"))


_PR = f"""
WITH {SCORED}, {_AP_SQL.format(src='scored')},
pr AS (SELECT t AS threshold, CASE WHEN k = 0 THEN 0.0 ELSE tp / k END AS precision,
              tp / (SELECT p FROM tot) AS recall FROM pts),
prf AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr)"""


@query("pr_curve", _PR + """
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf""")
def q_pr_curve(spark, sf_dir):
    cv = rk.curve(scored_events(spark, sf_dir), "score", "label")
    return rk.pr_curve(cv).select("threshold", *_r6("precision", "recall", "f1"))


@query("best_threshold", _PR + """
SELECT threshold AS best_threshold, round(f1, 6) AS best_f1, round(precision, 6) AS precision_at_best,
       round(recall, 6) AS recall_at_best
FROM prf ORDER BY f1 DESC, threshold ASC LIMIT 1""")
def q_best_threshold(spark, sf_dir):
    cv = rk.curve(scored_events(spark, sf_dir), "score", "label")
    b = rk.best_threshold(rk.pr_curve(cv))
    return b.select("best_threshold", *_r6("best_f1", "precision_at_best", "recall_at_best"))


@query("high_recall_threshold", _PR + """
SELECT threshold AS high_recall_threshold, round(precision, 6) AS high_recall_precision,
       round(recall, 6) AS high_recall_recall
FROM prf WHERE precision >= 0.30 ORDER BY recall DESC, threshold ASC LIMIT 1""")
def q_high_recall_threshold(spark, sf_dir):
    cv = rk.curve(scored_events(spark, sf_dir), "score", "label")
    b = rk.high_recall_threshold(rk.pr_curve(cv))
    return b.select("high_recall_threshold", *_r6("high_recall_precision", "high_recall_recall"))


@query("model_comparison", f"""
WITH {STACKED},
r AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
             + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS mr FROM stacked),
roc AS (SELECT model, (sum(mr) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
                       * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                      / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS roc_auc
        FROM r GROUP BY model),
c AS (SELECT model, score AS t, sum(label) AS pos, count(*) AS n FROM stacked GROUP BY model, score),
cum AS (SELECT model, t, pos,
               sum(pos) OVER (PARTITION BY model ORDER BY t DESC) AS tp,
               sum(n) OVER (PARTITION BY model ORDER BY t DESC) AS k,
               sum(pos) OVER (PARTITION BY model) AS p FROM c),
ap AS (SELECT model, sum(pos * 1.0 / p * tp / k) AS pr_auc FROM cum GROUP BY model),
cm AS (SELECT model,
              count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn,
              count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
              count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
              count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
              count(*) AS n_samples, count(*) FILTER (WHERE label = 1) AS n_positive
       FROM stacked GROUP BY model),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS pr,
                CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS re FROM cm)
SELECT m.model, 0.5::DOUBLE AS threshold, round(roc.roc_auc, 6) AS roc_auc, round(ap.pr_auc, 6) AS pr_auc,
       round(pr, 6) AS precision, round(re, 6) AS recall,
       round(CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END, 6) AS f1,
       tn, fp, fn, tp, n_samples, n_positive
FROM m JOIN roc USING (model) JOIN ap USING (model)""")
def q_model_comparison(spark, sf_dir):
    ev = rk.evaluate(stacked_scores(spark, sf_dir), "score", "label", FLAG_THRESHOLD, groups=["model"])
    return ev.select("model", "threshold", *_r6("roc_auc", "pr_auc", "precision", "recall", "f1"),
                     "tn", "fp", "fn", "tp", "n_samples", "n_positive")
