"""Registered queries: quantile edges, histograms, PSI, drift reports/cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import micros
from vigil.operators import drift as dr
from vigil.operators.select import keys_at
from vigil.operators.split import in_split, time_split
from vigil.plans.catalog import query
from vigil.plans.q_metrics import SCORED, scored_events
from vigil.plans.sqlparts import SPLIT, psi_sql
from vigil.sources.tables import read_table

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Registered queries round their edges, so that bins do not hang on the last
# bits of an engine's interpolation formula.
EDGE_DECIMALS = 9


def lineitem_windows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Reference = ship dates before the date at position int(0.7 n);
    current = ship dates from the date at position int(0.85 n) on. The cut
    dates are values, so tied dates never straddle a cut."""
    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate", *LINE_FEATURES)
    li = li.withColumn("_us", micros("l_shipdate"))
    n = li.count()
    c70, c85 = int(n * 0.7), int(n * (0.7 + 0.15))
    keys = keys_at(li.select("_us"), ["_us"], [c70, c85])
    return li.where(F.col("_us") < keys[c70][0]), li.where(F.col("_us") >= keys[c85][0])


LINE_SQL = """
li AS (SELECT *, epoch_us(l_shipdate) AS us FROM lineitem),
pos AS (SELECT us, row_number() OVER (ORDER BY us) - 1 AS idx FROM li),
cut AS (SELECT (SELECT us FROM pos WHERE idx = (SELECT CAST(floor(count(*) * 0.7::DOUBLE) AS BIGINT) FROM li)) AS d70,
               (SELECT us FROM pos WHERE idx = (SELECT CAST(floor(count(*) * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) FROM li)) AS d85),
ref AS (SELECT * FROM li WHERE us < (SELECT d70 FROM cut)),
cur AS (SELECT * FROM li WHERE us >= (SELECT d85 FROM cut))"""


@query("quantile_edges", f"""
WITH {LINE_SQL},
{psi_sql('ref', 'cur', LINE_FEATURES)}
SELECT feature, i AS edge_index, q[i] AS edge FROM edges, range(1, 10) t(i)""")
def q_quantile_edges(spark, sf_dir):
    ref, _ = lineitem_windows(spark, sf_dir)
    edges = dr.quantile_edges(ref, LINE_FEATURES, edge_decimals=EDGE_DECIMALS)
    rows = [(f, i + 1, e) for f, es in edges.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "feature string, edge_index long, edge double")


@query("histogram", f"""
WITH {LINE_SQL},
{psi_sql('ref', 'cur', LINE_FEATURES)}
SELECT g.feature, g.bin, coalesce(r.c, 0) AS ref_count, coalesce(c.c, 0) AS cur_count
FROM grid g LEFT JOIN rc r USING (feature, bin) LEFT JOIN cc c USING (feature, bin)""")
def q_histogram(spark, sf_dir):
    ref, cur = lineitem_windows(spark, sf_dir)
    edges = dr.quantile_edges(ref, LINE_FEATURES, edge_decimals=EDGE_DECIMALS)
    r = dr.bin_counts(ref, edges).select("feature", "bin", F.col("cnt").alias("ref_count"))
    c = dr.bin_counts(cur, edges).select("feature", "bin", F.col("cnt").alias("cur_count"))
    return r.join(c, ["feature", "bin"]).select(
        "feature", F.col("bin").cast("long").alias("bin"), F.col("ref_count").cast("long").alias("ref_count"),
        F.col("cur_count").cast("long").alias("cur_count"))


@query("psi", f"""
WITH {LINE_SQL},
{psi_sql('ref', 'cur', ['l_extendedprice'])}
SELECT round(psi, 6) AS psi FROM psi""")
def q_psi(spark, sf_dir):
    ref, cur = lineitem_windows(spark, sf_dir)
    psi, _ = dr.drift_psi(ref, cur, ["l_extendedprice"], edge_decimals=EDGE_DECIMALS)
    return psi.select(F.round("psi", 6).alias("psi"))


_BAND = "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END"


@query("psi_report", f"""
WITH {LINE_SQL},
{psi_sql('ref', 'cur', LINE_FEATURES)},
eff AS (SELECT feature, 2 + len(list_filter(range(1, 9), lambda i: q[i + 1] > q[i])) AS n_effective_bins FROM edges)
SELECT feature, round(psi, 4) AS psi, {_BAND} AS status, CAST(n_effective_bins AS INTEGER) AS n_effective_bins
FROM psi JOIN eff USING (feature)""")
def q_psi_report(spark, sf_dir):
    ref, cur = lineitem_windows(spark, sf_dir)
    return dr.feature_drift_report(ref, cur, LINE_FEATURES, edge_decimals=EDGE_DECIMALS)


SCORED_SPLIT = SCORED + ",\n" + SPLIT.replace(
    "FROM tx\n", "FROM scored\n", 1)


def scored_split(spark, sf_dir):
    st, info = time_split(scored_events(spark, sf_dir))
    return st.where(in_split(st, info, "train")), st.where(in_split(st, info, "test")), st


@query("prediction_drift", f"""
WITH {SCORED_SPLIT},
r0 AS (SELECT * FROM stx WHERE split = 'train'), c0 AS (SELECT * FROM stx WHERE split = 'test'),
{psi_sql('r0', 'c0', ['score'])}
SELECT round(psi, 4) AS score_psi,
       (SELECT avg(score) FROM r0) AS reference_mean_score, (SELECT avg(score) FROM c0) AS current_mean_score,
       (SELECT avg(CAST(score >= 0.5 AS DOUBLE)) FROM r0) AS reference_flagged_rate,
       (SELECT avg(CAST(score >= 0.5 AS DOUBLE)) FROM c0) AS current_flagged_rate,
       {_BAND} AS status
FROM psi""")
def q_prediction_drift(spark, sf_dir):
    ref, cur, _ = scored_split(spark, sf_dir)
    out = dr.prediction_drift(ref, cur, "score", edge_decimals=EDGE_DECIMALS)
    return out.select("score_psi", *[F.round(c, 9).alias(c) for c in (
        "reference_mean_score", "current_mean_score", "reference_flagged_rate", "current_flagged_rate")],
        "status")


@query("drift_cycle", f"""
WITH {LINE_SQL},
{psi_sql('ref', 'cur', LINE_FEATURES)},
rep AS (SELECT feature, round(psi, 4) AS p4, {_BAND} AS status FROM psi),
rec AS (SELECT count(*) AS n_features_checked,
               count(*) FILTER (WHERE status = 'significant_shift') AS n_significant_features,
               coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'significant_shift'), '')
                 AS significant_features,
               string_agg(feature, ',' ORDER BY p4 DESC, feature) AS top_features
        FROM rep)
SELECT n_features_checked, n_significant_features, significant_features, top_features,
       n_significant_features >= 3 AS drift_alert
FROM rec""")
def q_drift_cycle(spark, sf_dir):
    """Drift cycle over the lineitem numeric features (no score feed)."""
    ref, cur = lineitem_windows(spark, sf_dir)
    report = dr.feature_drift_report(ref, cur, LINE_FEATURES, edge_decimals=EDGE_DECIMALS)
    rec = dr.drift_cycle(report, None)
    return rec.select("n_features_checked", "n_significant_features",
                      F.array_join("significant_features", ",").alias("significant_features"),
                      F.array_join(F.transform("top_feature_psi", lambda s: s["feature"]), ",").alias("top_features"),
                      "drift_alert")


@query("hourly_drift", f"""
WITH {SCORED_SPLIT},
r0 AS (SELECT * FROM stx WHERE split = 'train'),
c0 AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM stx),
{psi_sql('r0', 'c0', ['score'], group_col='window_start')}
SELECT window_start, round(psi, 4) AS score_psi, {_BAND} AS status FROM psi""")
def q_hourly_drift(spark, sf_dir):
    """Batch form of the hourly monitoring cadence: score PSI of every
    one-hour tumbling window against the train split."""
    ref, _, st = scored_split(spark, sf_dir)
    cur = st.withColumn("window_start", F.window("ts", "1 hour").start.cast("timestamp_ntz"))
    psi, _ = dr.drift_psi(ref, cur, ["score"], groups=["window_start"], edge_decimals=EDGE_DECIMALS)
    return psi.select("window_start", F.round("psi", 4).alias("score_psi"),
                      F.when(F.col("psi") < 0.1, "stable").when(F.col("psi") < 0.25, "moderate_shift")
                      .otherwise("significant_shift").alias("status"))
