"""Exact ranking metrics (A6-A12, A21, A23) on the M0 primitive.

Scores are first aggregated to one row per (group, distinct score) with
positive and total counts (map-side partial aggregation, so a score value
shared by a third of the rows is one partial row per task). The descending
cumulative counts along (group, score desc) come from range-partitioned
prefix sums (vigil.operators.order), never from a window without
PARTITION BY. Every metric is then a plain aggregate over that curve.

Definitions (ties are one threshold, ``score >= t``):
  TP_i, K_i  positives / rows with score >= s_i
  ROC-AUC    sum_i pos_i * (neg strictly below s_i + neg_i / 2) / (P * N)
  AP         sum_i (pos_i / P) * (TP_i / K_i)   (step sum, not trapezoids)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.config import F1_TUNING_EPS, HIGH_RECALL_MIN_PRECISION
from vigil.functions.columns import safe_div
from vigil.operators.joins import kept, lookup_join
from vigil.operators.order import with_running_sums


def score_counts(df: DataFrame, score: str, label: str, groups=()) -> DataFrame:
    return (df.groupBy(*groups, F.col(score).alias("threshold"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.count(F.lit(1)).alias("n")))


def curve(df: DataFrame, score: str = "score", label: str = "label", groups=()) -> DataFrame:
    """One row per (group, distinct score): threshold, pos, neg, tp, fp, k,
    p_total, n_total (cumulative values are over score >= threshold)."""
    groups = list(groups)
    counts = kept(score_counts(df, score, label, groups))  # the rows are scored and read once
    order = [*[F.col(g) for g in groups], F.col("threshold").desc()]
    run = with_running_sums(counts, order, {"_cpos": F.col("pos"), "_cn": F.col("n")})
    gt = counts.groupBy(*groups).agg(F.sum("pos").alias("p_total"), F.sum("n").alias("_nt"))
    if groups:
        # rows before each group in the global order: an exclusive prefix
        # over the group totals, itself range-partitioned (groups may be many)
        gt = with_running_sums(gt, [F.col(g) for g in groups],
                               {"_pb": F.col("p_total"), "_nb": F.col("_nt")}, inclusive=False)
        gt = gt.withColumns({"p_total": F.col("p_total"), "_pb": F.coalesce("_pb", F.lit(0)),
                             "_nb": F.coalesce("_nb", F.lit(0))})
        run = lookup_join(run, gt, groups, how="inner")
    else:
        tot = gt.first()
        # longs as in the grouped form; a small Python number alone is an int
        zero = F.lit(0).cast("long")
        run = run.withColumns({"p_total": F.lit(tot["p_total"] or 0).cast("long"),
                               "_nt": F.lit(tot["_nt"] or 0).cast("long"), "_pb": zero, "_nb": zero})
    tp = F.col("_cpos") - F.col("_pb")
    k = F.col("_cn") - F.col("_nb")
    return run.select(
        *groups, "threshold", "pos", (F.col("n") - F.col("pos")).alias("neg"),
        tp.alias("tp"), (k - tp).alias("fp"), k.alias("k"),
        F.col("p_total"), (F.col("_nt") - F.col("p_total")).alias("n_total"))


def pr_curve(cv: DataFrame, groups=()) -> DataFrame:
    """A10: precision, recall and the tuning F1 (with its +1e-12) per threshold."""
    p = safe_div("tp", "k")
    r = F.when(F.col("p_total") > 0, F.col("tp") / F.col("p_total")).otherwise(F.lit(1.0))
    f1 = 2 * p * r / (p + r + F.lit(F1_TUNING_EPS))
    return cv.select(*groups, "threshold", p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def ranking_summary(cv: DataFrame, groups=()) -> DataFrame:
    """A8 + A9 per group: roc_auc (null when one class is absent), pr_auc.
    Products of counts are doubles, which no number of rows overflows."""
    groups = list(groups)
    below_neg = F.col("n_total") - (F.col("fp"))  # negatives strictly below the threshold
    roc_term = F.col("pos") * (below_neg + F.col("neg") / 2.0)
    ap_term = F.col("pos").cast("double") * F.col("tp") / F.col("k")
    agg = cv.groupBy(*groups).agg(
        F.sum(roc_term).alias("_roc"), F.sum(ap_term).alias("_ap"),
        F.first("p_total").alias("_p"), F.first("n_total").alias("_n"))
    roc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_roc") / (F.col("_p").cast("double") * F.col("_n")))
    ap = F.when(F.col("_p") > 0, F.col("_ap") / F.col("_p"))
    return agg.select(*groups, roc.alias("roc_auc"), ap.alias("pr_auc"))


def best_threshold(pr: DataFrame, groups=()) -> DataFrame:
    """Max F1, ties to the lowest threshold. A distributed max over a
    struct (f1, -threshold, ...), no sort of the curve."""
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("nt"),
                          F.col("threshold"), F.col("precision"), F.col("recall")))
    return pr.groupBy(*groups).agg(best.alias("b")).where(F.col("b").isNotNull()).select(
        *groups, F.col("b.threshold").alias("best_threshold"), F.col("b.f1").alias("best_f1"),
        F.col("b.precision").alias("precision_at_best"), F.col("b.recall").alias("recall_at_best"))


def high_recall_threshold(pr: DataFrame, groups=(), min_precision: float = HIGH_RECALL_MIN_PRECISION) -> DataFrame:
    """Among thresholds with precision >= floor, the highest recall;
    recall only falls as the threshold rises, so that is the lowest eligible
    threshold. No row for a group without an eligible threshold."""
    lo = F.min(F.struct(F.col("threshold"), F.col("precision"), F.col("recall")))
    return (pr.where(F.col("precision") >= min_precision).groupBy(*groups).agg(lo.alias("b"))
              .where(F.col("b").isNotNull())
              .select(*groups, F.col("b.threshold").alias("high_recall_threshold"),
                      F.col("b.precision").alias("high_recall_precision"),
                      F.col("b.recall").alias("high_recall_recall")))


def confusion(df: DataFrame, score: str, label: str, threshold, groups=()) -> DataFrame:
    """A6 + A21 at a fixed threshold (float, or a column name holding a
    per-group threshold): tn, fp, fn, tp, n_samples, n_positive."""
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return df.groupBy(*groups).agg(
        F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp"),
        F.count(F.lit(1)).alias("n_samples"), F.count_if(y).alias("n_positive"))


def prf_columns(tp="tp", fp="fp", fn="fn") -> list[Column]:
    """Precision, recall, F1 with 0 on zero division."""
    p = safe_div(F.col(tp), F.col(tp) + F.col(fp))
    r = safe_div(F.col(tp), F.col(tp) + F.col(fn))
    f1 = safe_div(2 * p * r, p + r)
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def evaluate(df: DataFrame, score: str = "score", label: str = "label", threshold=0.5,
             groups=()) -> DataFrame:
    """A23 / evaluate_model: one metric row per group (e.g. per model). A
    float threshold is shared; a column name gives a per-row threshold."""
    groups = list(groups)
    if not groups:
        return evaluate(df.withColumn("_all", F.lit(0)), score, label, threshold, ["_all"]).drop("_all")
    cv = curve(df, score, label, groups)
    rank = ranking_summary(cv, groups)
    cm = confusion(df, score, label, threshold, groups).select("*", *prf_columns())
    out = rank.join(cm, groups, "inner")
    if isinstance(threshold, str):
        return out
    return out.withColumn("threshold", F.lit(float(threshold)))


def class_ratio(df: DataFrame, label: str = "label", groups=()) -> DataFrame:
    """A5: n_negative / max(n_positive, 1)."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return df.groupBy(*groups).agg(pos.alias("n_positive"), neg.alias("n_negative")).withColumn(
        "ratio", F.col("n_negative") / F.greatest(F.col("n_positive"), F.lit(1)))
