"""Registered queries: fingerprint, latency summary, set operations, score-log
windows, overrides, map columns, sampling and additive explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.config import ROLES
from vigil.operators import explain as ex
from vigil.operators import features as fe
from vigil.operators.fingerprint import fingerprint
from vigil.operators.latency import latency_summary
from vigil.operators.split import in_split, hash_sample, time_split
from vigil.plans.catalog import ORACLE, query
from vigil.plans.q_features import events_tx, orders_tx, q_feature_matrix
from vigil.plans.q_metrics import SCORED, scored_events
from vigil.plans.sqlparts import RISK, SPLIT, TX_EVENTS
from vigil.sources.tables import read_table

# Fixed weights of the linear score whose exact attributions are reported.
LINEAR_WEIGHTS = {
    "amount": 0.004,
    "seconds_since_last_txn": -0.000001,
    "velocity_count_10m": 0.3,
    "velocity_amount_10m": 0.001,
    "velocity_count_60m": 0.2,
    "velocity_amount_60m": 0.0005,
    "velocity_count_1440m": 0.05,
    "velocity_amount_1440m": 0.0001,
    "merchant_risk_score": 5.0,
    "merchant_category_risk_score": 3.0,
    "is_new_device": 0.8,
    "distinct_device_count_so_far": 0.1,
}
FEATS = list(LINEAR_WEIGHTS)


@query("fingerprint", f"""
WITH {TX_EVENTS},
k AS (SELECT CAST(transaction_id AS VARCHAR) AS k FROM tx),
b AS (SELECT substr(md5(k), 1, 3) AS b, count(*) AS n, sha256(string_agg(k, chr(10) ORDER BY k)) AS d FROM k GROUP BY 1),
g AS (SELECT substr(b, 1, 2) AS g, sum(n) AS n, sha256(string_agg(d, chr(10) ORDER BY b)) AS d FROM b GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, sha256(string_agg(d, chr(10) ORDER BY g)) AS content_sha256,
       (SELECT min(ts) FROM tx) AS date_min, (SELECT max(ts) FROM tx) AS date_max FROM g""")
def q_fingerprint(spark, sf_dir):
    return fingerprint(events_tx(spark, sf_dir))


@query("latency_summary", """
WITH lg AS (SELECT event_id, ts, value AS latency_ms, event_type <> 'error' AS ok FROM events),
good AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms, event_id) - 1 AS idx FROM lg WHERE ok),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok, max(latency_ms) FILTER (WHERE ok) AS mx,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS wall FROM lg)
SELECT n AS n_requests, n_ok, n - n_ok AS n_errors, (n - n_ok) / n * 100 AS error_pct, wall AS wall_s,
       n_ok / wall AS rps, mx AS latency_max,
       (SELECT latency_ms FROM good WHERE idx = CAST(round_even(0.5::DOUBLE * (n_ok - 1), 0) AS BIGINT)) AS p50,
       (SELECT latency_ms FROM good WHERE idx = CAST(round_even(0.95::DOUBLE * (n_ok - 1), 0) AS BIGINT)) AS p95,
       (SELECT latency_ms FROM good WHERE idx = CAST(round_even(0.99::DOUBLE * (n_ok - 1), 0) AS BIGINT)) AS p99
FROM t""")
def q_latency_summary(spark, sf_dir):
    """Request log read from events: value = latency in ms, error events
    are failed requests."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("value").alias("latency_ms"), (F.col("event_type") != "error").alias("ok"))
    return latency_summary(ev, "latency_ms", "ok", "ts", "event_id")


_CANON = "transaction_id, customer_id, merchant_id, merchant_category, device_id, ts, amount, label"


@query("union_regimes", f"""
WITH {TX_EVENTS}, o AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(NULL AS BIGINT) AS merchant_id,
         o_orderpriority AS merchant_category, o_orderstatus AS device_id, o_orderdate AS ts,
         o_totalprice AS amount, CAST(NULL AS INTEGER) AS label FROM orders
  WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))
SELECT 'events' AS regime, {_CANON} FROM tx
UNION ALL SELECT 'orders', {_CANON} FROM o""")
def q_union_regimes(spark, sf_dir):
    """Bag union by column name of two canonical sources."""
    e = events_tx(spark, sf_dir).withColumn("regime", F.lit("events"))
    o = orders_tx(spark, sf_dir).withColumn("regime", F.lit("orders"))
    return e.unionByName(o).select("regime", *_CANON.split(", "))


@query("device_union", f"""
WITH {TX_EVENTS}, {SPLIT}
SELECT customer_id, device_id FROM stx WHERE split = 'train'
UNION
SELECT customer_id, device_id FROM stx WHERE split = 'val'""")
def q_device_union(spark, sf_dir):
    """Known devices of train united with the devices seen in val."""
    st, info = time_split(events_tx(spark, sf_dir))
    tr = st.where(in_split(st, info, "train")).select(ROLES.customer, ROLES.device)
    va = st.where(in_split(st, info, "val")).select(ROLES.customer, ROLES.device)
    return tr.unionByName(va).distinct()


@query("recent_window", f"""
WITH {SCORED}
SELECT transaction_id, ts, score FROM scored
WHERE ts > (SELECT max(ts) FROM scored) - INTERVAL 1 DAY""")
def q_recent_window(spark, sf_dir):
    """Live-batch provider: the last day of the score log (a ts range filter
    that prunes by the scan's min/max statistics)."""
    s = scored_events(spark, sf_dir)
    last = s.agg(F.max("ts")).first()[0]
    return s.where(F.col("ts") > F.lit(last) - F.expr("INTERVAL 1 DAY")).select("transaction_id", "ts", "score")


@query("risk_override", f"""
WITH {TX_EVENTS}, {SPLIT}, {RISK}
SELECT s.transaction_id,
       round(coalesce(CASE WHEN s.amount > 400 THEN 0.9 END, m.merchant_risk_score, (SELECT gm FROM g)), 6)
         AS merchant_risk_score
FROM stx s LEFT JOIN mrisk m USING (merchant_id)""")
def q_risk_override(spark, sf_dir):
    """A caller-supplied merchant risk (here for large amounts) wins over the
    train-fit lookup, which wins over the global mean."""
    st, info = time_split(events_tx(spark, sf_dir))
    maps = fe.fit_risk_maps(st.where(in_split(st, info, "train")))
    given = st.withColumn("given_risk", F.when(F.col("amount") > 400, F.lit(0.9)))
    out = fe.apply_risk_maps(given, maps, merchant_override="given_risk")
    return out.select("transaction_id", F.round("merchant_risk_score", 6).alias("merchant_risk_score"))


@query("map_features", r"""
SELECT event_id AS transaction_id,
       CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS DOUBLE) AS k,
       value AS amount
FROM events""")
def q_map_features(spark, sf_dir):
    """A features map column (parsed from props) projected to columns; an
    'amount' entry would override the amount column."""
    ev = read_table(spark, sf_dir, "events")
    m = F.from_json("props", "map<string,double>")
    return ev.select(F.col("event_id").alias("transaction_id"), m.alias("features"), "value").select(
        "transaction_id", F.col("features")["k"].alias("k"),
        F.coalesce(F.col("features")["amount"], F.col("value")).alias("amount"))


@query("hash_sample", f"""
WITH {TX_EVENTS}
SELECT transaction_id, customer_id, ts, amount FROM tx
ORDER BY md5(CAST(transaction_id AS VARCHAR) || '|42'), transaction_id LIMIT 500""")
def q_hash_sample(spark, sf_dir):
    """Deterministic monitoring sample of 500 rows."""
    return hash_sample(events_tx(spark, sf_dir), 500).select("transaction_id", "customer_id", "ts", "amount")


def _contrib(spark, sf_dir):
    fm = q_feature_matrix(spark, sf_dir)
    means = ex.background_means(fm.where(F.col("split") == "train"), FEATS)
    return ex.linear_contributions(fm, LINEAR_WEIGHTS, means)


def _fm_sql():
    return "fm AS (" + ORACLE["feature_matrix"].strip() + ")"


def _contrib_sql():
    means = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m_{f}" for f in FEATS)
    phis = ", ".join(f"{w!r} * (CAST({f} AS DOUBLE) - m_{f}) AS phi_{f}" for f, w in LINEAR_WEIGHTS.items())
    return (f"WITH {_fm_sql()}, bg AS (SELECT {means} FROM fm WHERE split = 'train'), "
            f"ph AS (SELECT fm.*, {phis} FROM fm, bg)")


@query("linear_contrib", _contrib_sql() + " SELECT transaction_id, " + ", ".join(
    f"round(phi_{f}, 6) AS phi_{f}" for f in FEATS) + " FROM ph")
def q_linear_contrib(spark, sf_dir):
    c = _contrib(spark, sf_dir)
    return c.select("transaction_id", *[F.round("phi_" + f, 6).alias("phi_" + f) for f in FEATS])


@query("global_importance", _contrib_sql() + ", lg AS (UNPIVOT (SELECT " + ", ".join(
    f"abs(phi_{f}) AS {f}" for f in FEATS) + " FROM ph) ON " + ", ".join(FEATS) +
    " INTO NAME feature VALUE a) SELECT feature, round(avg(a), 6) AS mean_abs_contribution FROM lg "
    "GROUP BY feature ORDER BY avg(a) DESC, feature LIMIT 15")
def q_global_importance(spark, sf_dir):
    g = ex.global_importance(_contrib(spark, sf_dir), FEATS)
    return g.select("feature", F.round("mean_abs_contribution", 6).alias("mean_abs_contribution"))


@query("row_explanations", _contrib_sql() + ", lg AS (UNPIVOT (SELECT transaction_id, " + ", ".join(
    f"{{'v': CAST({f} AS DOUBLE), 'c': phi_{f}}} AS {f}" for f in FEATS) + " FROM ph) ON " + ", ".join(FEATS) +
    " INTO NAME feature VALUE s), rk AS (SELECT transaction_id, feature, s.v AS value, s.c AS contribution, "
    "row_number() OVER (PARTITION BY transaction_id ORDER BY abs(s.c) DESC, feature) AS rank FROM lg) "
    "SELECT transaction_id, rank, feature, value, round(contribution, 6) AS contribution, "
    "CASE WHEN contribution > 0 THEN 'increased fraud risk' ELSE 'decreased fraud risk' END AS effect "
    "FROM rk WHERE rank <= 8")
def q_row_explanations(spark, sf_dir):
    r = ex.row_explanations(_contrib(spark, sf_dir), FEATS, "transaction_id")
    return r.select("transaction_id", F.col("rank").cast("bigint").alias("rank"), "feature", "value",
                    F.round("contribution", 6).alias("contribution"), "effect")
