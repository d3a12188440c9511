"""Registered queries: sources, adapters, splits, causal features, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.config import FeatureConfig, ROLES
from vigil.operators import features as fe
from vigil.operators.split import in_split, SPLITS, first_n, newest_window, regime_cut, split_summary, time_split
from vigil.plans.catalog import ORACLE, query
from vigil.plans.feature_pipeline import build_features
from vigil.plans.sqlparts import RISK, SPLIT, TX_EVENTS, TX_ORDERS, velocity_sql
from vigil.sources.adapters import derive_timestamp, transactions_from_events, transactions_from_orders
from vigil.sources.tables import read_table

EVENT_WINDOWS = (10, 60, 1440, 10080)          # minutes
ORDER_WINDOWS = (10080, 43200, 525600)         # 7, 30, 365 days in minutes
CANON = ["transaction_id", "customer_id", "merchant_id", "merchant_category",
         "device_id", "ts", "amount", "label"]


def events_tx(spark, sf_dir):
    return transactions_from_events(read_table(spark, sf_dir, "events"))


def orders_tx(spark, sf_dir):
    return transactions_from_orders(read_table(spark, sf_dir, "orders"))


def _vel_cols(windows):
    out = []
    for w in windows:
        out += [F.col(f"velocity_count_{w}m"),
                F.round(f"velocity_amount_{w}m", 2).alias(f"velocity_amount_{w}m")]
    return out


# ---------------------------------------------------------------- sources
@query("scan_transactions", f"WITH {TX_EVENTS} SELECT {', '.join(CANON)} FROM tx")
def scan_transactions(spark, sf_dir):
    return events_tx(spark, sf_dir)


@query("canonical_orders", f"WITH {TX_ORDERS} SELECT {', '.join(CANON)} FROM tx")
def canonical_orders(spark, sf_dir):
    return orders_tx(spark, sf_dir)


@query("derive_timestamp", """
SELECT event_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT)) AS derived_ts
FROM events""")
def derive_ts(spark, sf_dir):
    """Event value read as minutes after the base date (the Time-offset path)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", (F.col("value") * 60).alias("time_s"))
    return derive_timestamp(ev, seconds_col="time_s", out="derived_ts").select("event_id", "derived_ts")


@query("first_n", f"""
WITH {TX_ORDERS}
SELECT transaction_id, customer_id, ts, amount FROM tx
ORDER BY us, transaction_id LIMIT 1000""")
def q_first_n(spark, sf_dir):
    """The first 1,000 orders in time order, with ties on the day."""
    return first_n(orders_tx(spark, sf_dir), 1_000).select("transaction_id", "customer_id", "ts", "amount")


# ---------------------------------------------------------------- splits
@query("time_split", f"WITH {TX_EVENTS}, {SPLIT} SELECT transaction_id, split FROM stx")
def q_time_split(spark, sf_dir):
    out, _ = time_split(events_tx(spark, sf_dir))
    return out.select("transaction_id", "split")


@query("split_summary", f"""
WITH {TX_EVENTS}, {SPLIT}
SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive,
       round(avg(label), 6) AS positive_rate
FROM stx GROUP BY split""")
def q_split_summary(spark, sf_dir):
    out, _ = time_split(events_tx(spark, sf_dir))
    s = split_summary(out)
    return s.withColumn("positive_rate", F.round("positive_rate", 6))


@query("time_split_orders", f"WITH {TX_ORDERS}, {SPLIT} SELECT transaction_id, split FROM stx")
def q_time_split_orders(spark, sf_dir):
    """Split on day-grained orders, where many rows share a timestamp."""
    out, _ = time_split(orders_tx(spark, sf_dir))
    return out.select("transaction_id", "split")


@query("newest_window", f"""
WITH {TX_EVENTS},
r AS (SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS idx, count(*) OVER () AS n_all FROM tx)
SELECT transaction_id, ts FROM r
WHERE idx >= CAST(floor(n_all * (1.0::DOUBLE - 0.5::DOUBLE)) AS BIGINT)""")
def q_newest_window(spark, sf_dir):
    return newest_window(events_tx(spark, sf_dir), 0.5).select("transaction_id", "ts")


@query("regime_cut", f"""
WITH {TX_EVENTS},
r AS (SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS idx, count(*) OVER () AS n_all FROM tx)
SELECT transaction_id, CASE WHEN idx < CAST(floor(n_all * 0.55::DOUBLE) AS BIGINT) THEN 'before' ELSE 'after' END
       AS regime
FROM r""")
def q_regime_cut(spark, sf_dir):
    """Before/after regimes at int(0.55 n) in time order."""
    return regime_cut(events_tx(spark, sf_dir), 0.55).select("transaction_id", "regime")


# ---------------------------------------------------------------- windows
_NOSPLIT = "stx AS (SELECT *, 'all' AS split FROM tx)"


@query("recency", f"""
WITH {TX_EVENTS}
SELECT a.transaction_id, a.customer_id,
       coalesce((a.us - (SELECT max(b.us) FROM tx b
                         WHERE b.customer_id = a.customer_id
                           AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))) / 1e6,
                1e6) AS seconds_since_last_txn
FROM tx a""")
def q_recency(spark, sf_dir):
    return (fe.causal_features(events_tx(spark, sf_dir), FeatureConfig(windows_minutes=()))
            .select("transaction_id", "customer_id", "seconds_since_last_txn"))


@query("velocity_count", f"""
WITH {TX_EVENTS}, {_NOSPLIT}, {velocity_sql(EVENT_WINDOWS)}
SELECT transaction_id, {', '.join(f'velocity_count_{w}m' for w in EVENT_WINDOWS)} FROM vel""")
def q_velocity_count(spark, sf_dir):
    out = fe.causal_features(events_tx(spark, sf_dir), FeatureConfig(windows_minutes=EVENT_WINDOWS))
    return out.select("transaction_id", *[f"velocity_count_{w}m" for w in EVENT_WINDOWS])


@query("velocity_amount", f"""
WITH {TX_EVENTS}, {_NOSPLIT}, {velocity_sql(EVENT_WINDOWS)}
SELECT transaction_id, {', '.join(f'velocity_amount_{w}m' for w in EVENT_WINDOWS)} FROM vel""")
def q_velocity_amount(spark, sf_dir):
    out = fe.causal_features(events_tx(spark, sf_dir), FeatureConfig(windows_minutes=EVENT_WINDOWS))
    return out.select("transaction_id", *[F.round(f"velocity_amount_{w}m", 2).alias(f"velocity_amount_{w}m")
                                          for w in EVENT_WINDOWS])


@query("velocity_orders", f"""
WITH {TX_ORDERS}, {_NOSPLIT}, {velocity_sql(ORDER_WINDOWS)},
rec AS (
  SELECT a.transaction_id,
         coalesce((a.us - (SELECT max(b.us) FROM tx b WHERE b.customer_id = a.customer_id
                   AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))) / 1e6, 1e6)
           AS seconds_since_last_txn
  FROM tx a)
SELECT v.*, r.seconds_since_last_txn FROM vel v JOIN rec r USING (transaction_id)""")
def q_velocity_orders(spark, sf_dir):
    """Recency and velocity on day-grained orders (real timestamp ties)."""
    tx = fe.causal_features(orders_tx(spark, sf_dir), FeatureConfig(windows_minutes=ORDER_WINDOWS))
    return tx.select("transaction_id", *_vel_cols(ORDER_WINDOWS), "seconds_since_last_txn")


@query("is_new_device", f"""
WITH {TX_EVENTS}
SELECT a.transaction_id,
       CASE WHEN EXISTS (SELECT 1 FROM tx b WHERE b.customer_id = a.customer_id AND b.device_id = a.device_id
                         AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))
            THEN 0 ELSE 1 END AS is_new_device,
       (SELECT count(DISTINCT b.device_id) FROM tx b WHERE b.customer_id = a.customer_id
          AND (b.us < a.us OR (b.us = a.us AND b.transaction_id <= a.transaction_id))) AS distinct_device_count_so_far
FROM tx a""")
def q_is_new_device(spark, sf_dir):
    """Causal device consistency (no seeded devices), one history per customer."""
    out = fe.causal_features(events_tx(spark, sf_dir), FeatureConfig(windows_minutes=()))
    return out.select("transaction_id", "is_new_device", "distinct_device_count_so_far")


_KNOWN = "known AS (SELECT DISTINCT customer_id, device_id FROM stx WHERE split = 'train')"


@query("is_new_device_known", f"""
WITH {TX_EVENTS}, {SPLIT}, {_KNOWN}
SELECT a.transaction_id, a.split,
       CASE WHEN EXISTS (SELECT 1 FROM known k WHERE k.customer_id = a.customer_id AND k.device_id = a.device_id)
              OR EXISTS (SELECT 1 FROM stx b WHERE b.split = a.split AND b.customer_id = a.customer_id
                           AND b.device_id = a.device_id
                           AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))
            THEN 0 ELSE 1 END AS is_new_device,
       (SELECT count(*) FROM (
          SELECT k.device_id FROM known k WHERE k.customer_id = a.customer_id
          UNION
          SELECT b.device_id FROM stx b WHERE b.split = a.split AND b.customer_id = a.customer_id
            AND (b.us < a.us OR (b.us = a.us AND b.transaction_id <= a.transaction_id)))) AS distinct_device_count_so_far
FROM stx a""")
def q_is_new_device_known(spark, sf_dir):
    """Per-split device consistency seeded with the train split's devices."""
    st, info = time_split(events_tx(spark, sf_dir))
    known = fe.fit_known_devices(st.where(in_split(st, info, "train")))
    out = fe.causal_features(st, FeatureConfig(windows_minutes=()), known=known,
                             partition_keys=["split", ROLES.customer], split_values=list(SPLITS))
    return out.select("transaction_id", "split", "is_new_device", "distinct_device_count_so_far")


# ---------------------------------------------------------------- encoders
@query("merchant_risk", f"""
WITH {TX_EVENTS}, {SPLIT}, {RISK}
SELECT merchant_id, round(merchant_risk_score, 6) AS merchant_risk_score FROM mrisk""")
def q_merchant_risk(spark, sf_dir):
    st, info = time_split(events_tx(spark, sf_dir))
    maps = fe.fit_risk_maps(st.where(in_split(st, info, "train")))
    return maps.merchant.select("merchant_id", F.round("merchant_risk_score", 6).alias("merchant_risk_score"))


@query("category_risk", f"""
WITH {TX_EVENTS}, {SPLIT}, {RISK}
SELECT merchant_category, round(merchant_category_risk_score, 6) AS merchant_category_risk_score FROM crisk""")
def q_category_risk(spark, sf_dir):
    st, info = time_split(events_tx(spark, sf_dir))
    maps = fe.fit_risk_maps(st.where(in_split(st, info, "train")))
    return maps.category.select(
        "merchant_category",
        F.round("merchant_category_risk_score", 6).alias("merchant_category_risk_score"))


@query("known_devices", f"""
WITH {TX_EVENTS}, {SPLIT}
SELECT customer_id, count(DISTINCT device_id) AS n_known_devices FROM stx WHERE split = 'train'
GROUP BY customer_id""")
def q_known_devices(spark, sf_dir):
    st, info = time_split(events_tx(spark, sf_dir))
    known = fe.fit_known_devices(st.where(in_split(st, info, "train")))
    return known.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_known_devices"))


@query("apply_merchant_risk", f"""
WITH {TX_EVENTS}, {SPLIT}, {RISK}
SELECT s.transaction_id,
       round(coalesce(m.merchant_risk_score, (SELECT gm FROM g)), 6) AS merchant_risk_score,
       round(coalesce(c.merchant_category_risk_score, (SELECT gm FROM g)), 6) AS merchant_category_risk_score
FROM stx s LEFT JOIN mrisk m USING (merchant_id) LEFT JOIN crisk c USING (merchant_category)""")
def q_apply_merchant_risk(spark, sf_dir):
    st, info = time_split(events_tx(spark, sf_dir))
    maps = fe.fit_risk_maps(st.where(in_split(st, info, "train")))
    out = fe.apply_risk_maps(st, maps)
    return out.select("transaction_id",
                      F.round("merchant_risk_score", 6).alias("merchant_risk_score"),
                      F.round("merchant_category_risk_score", 6).alias("merchant_category_risk_score"))


@query("merchant_risk_causal", f"""
WITH {TX_EVENTS}, {SPLIT}, g AS (SELECT avg(label) AS gm FROM stx WHERE split = 'train')
SELECT a.transaction_id,
       round(((SELECT coalesce(sum(b.label), 0) FROM tx b WHERE b.merchant_id = a.merchant_id
                 AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))
              + (SELECT gm FROM g) * 20.0)
             / ((SELECT count(b.label) FROM tx b WHERE b.merchant_id = a.merchant_id
                 AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id))) + 20.0), 6)
         AS merchant_risk_score
FROM tx a""")
def q_merchant_risk_causal(spark, sf_dir):
    """Causal merchant encoding: each row sees only earlier labels of its
    merchant, smoothed toward the train split's rate."""
    tx = events_tx(spark, sf_dir)
    st, info = time_split(tx)
    g = fe.fit_risk_maps(st.where(in_split(st, info, "train"))).global_mean
    out = fe.causal_merchant_risk(tx, g)
    return out.select("transaction_id", F.round("merchant_risk_score", 6).alias("merchant_risk_score"))


_FM_WINDOWS = (10, 60, 1440)


@query("feature_matrix", f"""
WITH {TX_EVENTS}, {SPLIT}, {RISK}, {_KNOWN},
{velocity_sql(_FM_WINDOWS, partition_extra='split')},
rec AS (
  SELECT a.transaction_id,
         coalesce((a.us - (SELECT max(b.us) FROM stx b WHERE b.split = a.split AND b.customer_id = a.customer_id
                   AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))) / 1e6, 1e6)
           AS seconds_since_last_txn,
         CASE WHEN EXISTS (SELECT 1 FROM known k WHERE k.customer_id = a.customer_id AND k.device_id = a.device_id)
                OR EXISTS (SELECT 1 FROM stx b WHERE b.split = a.split AND b.customer_id = a.customer_id
                             AND b.device_id = a.device_id
                             AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))
              THEN 0 ELSE 1 END AS is_new_device,
         (SELECT count(*) FROM (
            SELECT k.device_id FROM known k WHERE k.customer_id = a.customer_id
            UNION
            SELECT b.device_id FROM stx b WHERE b.split = a.split AND b.customer_id = a.customer_id
              AND (b.us < a.us OR (b.us = a.us AND b.transaction_id <= a.transaction_id)))) AS distinct_device_count_so_far
  FROM stx a)
SELECT s.transaction_id, s.split, s.label, round(s.amount, 2) AS amount, r.seconds_since_last_txn,
       {', '.join(f'v.velocity_count_{w}m, v.velocity_amount_{w}m' for w in _FM_WINDOWS)},
       round(coalesce(m.merchant_risk_score, (SELECT gm FROM g)), 6) AS merchant_risk_score,
       round(coalesce(c.merchant_category_risk_score, (SELECT gm FROM g)), 6) AS merchant_category_risk_score,
       r.is_new_device, r.distinct_device_count_so_far
FROM stx s JOIN rec r USING (transaction_id) JOIN vel v USING (transaction_id)
LEFT JOIN mrisk m USING (merchant_id) LEFT JOIN crisk c USING (merchant_category)""")
def q_feature_matrix(spark, sf_dir, hot_key_rows=None):
    """The full batch feature pipeline (P1): split, per-split causal
    features, train-fit encoders, in model column order."""
    cfg = FeatureConfig(windows_minutes=_FM_WINDOWS)
    res = build_features(events_tx(spark, sf_dir), cfg, hot_key_rows=hot_key_rows)
    f = res.features
    return f.select(
        "transaction_id", "split", "label", F.round("amount", 2).alias("amount"),
        "seconds_since_last_txn", *_vel_cols(_FM_WINDOWS),
        F.round("merchant_risk_score", 6).alias("merchant_risk_score"),
        F.round("merchant_category_risk_score", 6).alias("merchant_category_risk_score"),
        "is_new_device", "distinct_device_count_so_far")


@query("feature_matrix_hot")
def q_feature_matrix_hot(spark, sf_dir):
    """The same feature matrix with every (split, customer) key sent through
    the skew-proof plan (range-partitioned prefix sums), as a hot customer
    holding a large share of the rows would be."""
    return q_feature_matrix(spark, sf_dir, hot_key_rows=-1)


@query("velocity_orders_hot")
def q_velocity_orders_hot(spark, sf_dir):
    """Recency and velocity on orders (with ties) through the skew-proof plan."""
    tx = fe.with_micros(orders_tx(spark, sf_dir))
    out = fe.causal_features(tx, FeatureConfig(windows_minutes=ORDER_WINDOWS), hot_key_rows=-1)
    return out.select("transaction_id", *_vel_cols(ORDER_WINDOWS), "seconds_since_last_txn")


# the skew-plan variants answer to the same oracles as their hash-plan twins
ORACLE["feature_matrix_hot"] = ORACLE["feature_matrix"]
ORACLE["velocity_orders_hot"] = ORACLE["velocity_orders"]


# ---------------------------------------------------------------- string ids, null keys
TEXT_IDS = """
stx AS (SELECT 'T' || reverse(CAST(transaction_id AS VARCHAR)) || '-' || CAST(transaction_id AS VARCHAR) AS transaction_id,
               CASE WHEN transaction_id % 3 = 0 THEN 'C0' WHEN transaction_id % 3 = 1 THEN NULL
                    ELSE 'U' || CAST(customer_id AS VARCHAR) END AS customer_id, device_id, amount,
               date_trunc('hour', ts) AS ts, epoch_us(date_trunc('hour', ts)) AS us, 'all' AS split
        FROM tx)"""


def skewed_tx(spark, sf_dir):
    """Events by the hour with string ids: a third of all rows on one customer,
    a third without one."""
    i = F.col("transaction_id")
    return events_tx(spark, sf_dir).withColumns({
        "transaction_id": F.concat(F.lit("T"), F.reverse(i.cast("string")), F.lit("-"), i),
        "customer_id": F.when(i % 3 == 0, F.lit("C0")).when(i % 3 == 2, F.concat(F.lit("U"), F.col("customer_id"))),
        "ts": F.date_trunc("hour", "ts").cast("timestamp_ntz")})


def _null_safe(sql: str) -> str:
    return sql.replace("a.customer_id = b.customer_id", "a.customer_id IS NOT DISTINCT FROM b.customer_id")


_EARLIER = "(b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id))"

SKEW_ROWS = 200


@query("velocity_skewed", _null_safe(f"""
WITH {TX_EVENTS}, {TEXT_IDS}, {velocity_sql(EVENT_WINDOWS)},
o AS (SELECT *, us - lag(us) OVER (PARTITION BY customer_id ORDER BY us, transaction_id) AS gap,
             row_number() OVER (PARTITION BY customer_id, device_id ORDER BY us, transaction_id) AS nth FROM stx)
SELECT o.transaction_id, coalesce(gap / 1e6, 1e6) AS seconds_since_last_txn,
       {', '.join(f'v.velocity_count_{w}m, v.velocity_amount_{w}m' for w in EVENT_WINDOWS)},
       CAST(nth = 1 AS INTEGER) AS is_new_device,
       CAST(count(*) FILTER (WHERE nth = 1) OVER (PARTITION BY customer_id ORDER BY us, o.transaction_id) AS BIGINT)
         AS distinct_device_count_so_far
FROM o JOIN vel v USING (transaction_id)"""))
def q_velocity_skewed(spark, sf_dir):
    """All causal features where a third of the rows share one customer and a
    third have none: those two keys take the running-sum plan."""
    out = fe.causal_features(skewed_tx(spark, sf_dir), FeatureConfig(windows_minutes=EVENT_WINDOWS), hot_key_rows=SKEW_ROWS)
    return out.select("transaction_id", "seconds_since_last_txn", *_vel_cols(EVENT_WINDOWS), "is_new_device",
                      "distinct_device_count_so_far")


@query("time_split_string_ids", f"""
WITH {TX_EVENTS},
t AS (SELECT 'T' || reverse(CAST(transaction_id AS VARCHAR)) || '-' || CAST(transaction_id AS VARCHAR) AS transaction_id,
             epoch_us(date_trunc('month', ts)) AS us FROM tx),
{SPLIT.replace('FROM tx', 'FROM t')}
SELECT transaction_id, split FROM stx""")
def q_time_split_string_ids(spark, sf_dir):
    """Split by month, so that nearly all rows share a time and the string id decides."""
    tx = skewed_tx(spark, sf_dir).withColumn("ts", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    out, _ = time_split(tx)
    return out.select("transaction_id", "split")


@query("feature_matrix_string_ids", _null_safe(f"""
WITH {TX_EVENTS}, {TEXT_IDS.replace('stx AS', 'tx2 AS').replace(", 'all' AS split", "")}, {SPLIT.replace('FROM tx', 'FROM tx2')},
{velocity_sql(EVENT_WINDOWS, partition_extra='split')},
known AS (SELECT DISTINCT customer_id, device_id FROM stx WHERE split = 'train'),
o AS (SELECT s.*, us - lag(us) OVER (PARTITION BY split, customer_id ORDER BY us, transaction_id) AS gap,
             row_number() OVER (PARTITION BY split, customer_id, device_id ORDER BY us, transaction_id) = 1
               AND NOT EXISTS (SELECT 1 FROM known k WHERE k.customer_id IS NOT DISTINCT FROM s.customer_id AND k.device_id = s.device_id)
               AS fresh,
             (SELECT count(*) FROM known k WHERE k.customer_id IS NOT DISTINCT FROM s.customer_id) AS n_known
      FROM stx s)
SELECT o.transaction_id, split, coalesce(gap / 1e6, 1e6) AS seconds_since_last_txn,
       {', '.join(f'v.velocity_count_{w}m, v.velocity_amount_{w}m' for w in EVENT_WINDOWS)},
       CAST(fresh AS INTEGER) AS is_new_device,
       n_known + CAST(count(*) FILTER (WHERE fresh) OVER (PARTITION BY split, customer_id ORDER BY us, o.transaction_id) AS BIGINT)
         AS distinct_device_count_so_far
FROM o JOIN vel v USING (transaction_id)"""))
def q_feature_matrix_string_ids(spark, sf_dir):
    """Causal features per split with the train split's devices known, on
    string ids and with rows that have no customer."""
    st, info = time_split(skewed_tx(spark, sf_dir))
    known = fe.fit_known_devices(st.where(in_split(st, info, "train")))
    out = fe.causal_features(st, FeatureConfig(windows_minutes=EVENT_WINDOWS), known, ["split", ROLES.customer], list(SPLITS),
                             hot_key_rows=SKEW_ROWS)
    return out.select("transaction_id", "split", "seconds_since_last_txn", *_vel_cols(EVENT_WINDOWS), "is_new_device",
                      "distinct_device_count_so_far")


# ---------------------------------------------------------------- raw model inputs
RAW_INPUTS = tuple(f"V{i}" for i in range(1, 29))


def profiled_tx(spark, sf_dir):
    """Events with 28 raw model inputs: the leading numbers of the customer's
    vector, null where the customer has none."""
    vectors = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("_vec"), *[F.col("embedding")[i].alias(v) for i, v in enumerate(RAW_INPUTS)])
    events = read_table(spark, sf_dir, "events")
    return transactions_from_events(events.join(vectors, events["user_id"] == vectors["_vec"], "left"), keep=RAW_INPUTS)


@query("feature_matrix_raw_inputs", f"""
SELECT f.*, {', '.join(f'CAST(e.embedding[{i + 1}] AS DOUBLE) AS {v}' for i, v in enumerate(RAW_INPUTS))}
FROM ({ORACLE["feature_matrix"]}) f JOIN events ev ON ev.event_id = f.transaction_id
LEFT JOIN embeddings e ON e.vec_id = ev.user_id""")
def q_feature_matrix_raw_inputs(spark, sf_dir, hot_key_rows=None):
    """The feature matrix with raw inputs of the source before the computed ones."""
    cfg = FeatureConfig(windows_minutes=_FM_WINDOWS, raw_inputs=RAW_INPUTS)
    f = build_features(profiled_tx(spark, sf_dir), cfg, hot_key_rows=hot_key_rows).features
    rounded = {"amount": 2, "merchant_risk_score": 6, "merchant_category_risk_score": 6}
    return f.select("transaction_id", "split", "label", *[
        F.round(c, rounded[c]).alias(c) if c in rounded else F.col(c) for c in cfg.feature_columns()])
