"""Registered queries: the streaming feature operator replayed over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.plans.catalog import query
from vigil.plans.q_features import events_tx
from vigil.plans.sqlparts import TX_EVENTS, velocity_sql
from vigil.streaming.online import replay

STREAM_WINDOWS = (10, 60, 1440)

_SQL = f"""
WITH {TX_EVENTS}, stx AS (SELECT *, 'all' AS split FROM tx), {velocity_sql(STREAM_WINDOWS)}
SELECT a.transaction_id,
       {', '.join(f'v.velocity_count_{w}m, v.velocity_amount_{w}m' for w in STREAM_WINDOWS)},
       coalesce((a.us - (SELECT max(b.us) FROM tx b WHERE b.customer_id = a.customer_id
                 AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))) / 1e6, 1e6)
         AS seconds_since_last_txn,
       CASE WHEN EXISTS (SELECT 1 FROM tx b WHERE b.customer_id = a.customer_id AND b.device_id = a.device_id
                         AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id)))
            THEN 0 ELSE 1 END AS is_new_device,
       (SELECT count(DISTINCT b.device_id) FROM tx b WHERE b.customer_id = a.customer_id
          AND (b.us < a.us OR (b.us = a.us AND b.transaction_id <= a.transaction_id))) AS distinct_device_count_so_far
FROM tx a JOIN vel v USING (transaction_id)"""


@query("online_features", _SQL)
def q_online_features(spark, sf_dir):
    """Events replayed as a stream, one week per micro-batch in time order,
    through the stateful operator; equals the batch causal features."""
    tx = events_tx(spark, sf_dir)
    out = replay(spark, tx, F.date_trunc("week", "ts"), STREAM_WINDOWS, name="online-features",
                 files=spark.sparkContext.defaultParallelism)
    cols = []
    for w in STREAM_WINDOWS:
        cols += [F.col(f"velocity_count_{w}m"), F.round(f"velocity_amount_{w}m", 2).alias(f"velocity_amount_{w}m")]
    return out.select("transaction_id", *cols, "seconds_since_last_txn",
                      F.col("is_new_device").cast("int").alias("is_new_device"),
                      "distinct_device_count_so_far")


@query("delayed_label_stream", f"""
WITH {TX_EVENTS}
SELECT transaction_id, customer_id, ts, amount, label,
       ts + to_hours(transaction_id % 72) AS label_ts
FROM tx""")
def q_delayed_label_stream(spark, sf_dir):
    """Score log and label feed replayed as two streams (weekly chunks each)
    and joined on the id within a 7-day event-time interval, with watermarks
    bounding the join state. Labels arrive 0-71 hours after the score."""
    from vigil.streaming.labels import replay_label_join
    tx = events_tx(spark, sf_dir)
    scores = tx.select("transaction_id", "customer_id", "ts", "amount")
    labels = tx.select("transaction_id", "label",
                       (F.col("ts") + F.make_dt_interval(hours=F.col("transaction_id") % 72)).alias("label_ts"))
    out = replay_label_join(spark, scores, labels, F.date_trunc("week", "ts"), F.date_trunc("week", "label_ts"),
                            name="delayed-labels")
    return out.select("transaction_id", "customer_id", "ts", "amount", "label", "label_ts")
