"""Late labels on streams (J4, streaming form) and the streaming drift
monitor (T10).

``delayed_label_join``: the score stream and the label stream are joined on
the transaction id with an event-time interval (a label counts if it arrives
within ``max_delay`` of the score). Both sides carry watermarks, so Spark
drops join state once no future label can match: state is bounded by the
label delay, not by the stream length.

``drift_monitor``: each micro-batch of the score stream is one drift cycle
against a stored reference profile (``foreachBatch``), written to a history
table under its batch id, so that a replay adds nothing; in production the query runs with ``trigger(processingTime='1 hour')``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import ROLES
from vigil.operators import drift as dr
from vigil.session import shared_dir
from vigil.sources.history import write_record
from vigil.streaming.online import stage_chunks, state_partitions


def delayed_label_join(scores: DataFrame, labels: DataFrame, max_delay: str = "7 days",
                       watermark: str = "1 day", key: str = ROLES.transaction_id,
                       score_ts: str = ROLES.ts, label_ts: str = "label_ts") -> DataFrame:
    # watermarks need TIMESTAMP (local-time) columns; the session zone is UTC
    s = scores.withColumn("_ets", F.col(score_ts).cast("timestamp")).withWatermark("_ets", watermark).alias("s")
    lab = labels.withColumn("_lts", F.col(label_ts).cast("timestamp")).withWatermark("_lts", watermark).alias("l")
    cond = F.expr(f"s.`{key}` = l.`{key}` AND l._lts >= s._ets AND l._lts <= s._ets + INTERVAL {max_delay}")
    other = [c for c in labels.columns if c != key]
    return s.join(lab, cond, "inner").select(
        *[F.col(f"s.`{c}`") for c in scores.columns], *[F.col(f"l.`{c}`") for c in other])


def replay_label_join(spark: SparkSession, scores: DataFrame, labels: DataFrame, score_chunk: F.Column,
                      label_chunk: F.Column, max_delay: str = "7 days", watermark: str = "1 day",
                      name: str = "labels", files: int = 4, key: str = ROLES.transaction_id) -> DataFrame:
    """Harness: replay both tables as file streams (one whole chunk of
    ``files`` files per micro-batch each, so both watermarks advance by whole
    chunks) through the interval join; returns the joined rows."""
    base = shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    stage_chunks(scores, score_chunk, f"{base}/scores", files=files, by=key)
    stage_chunks(labels, label_chunk, f"{base}/labels", files=files, by=key)
    s = spark.readStream.schema(scores.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/scores")
    lab = spark.readStream.schema(labels.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/labels")
    with state_partitions(spark):
        q = (delayed_label_join(s, lab, max_delay, watermark).writeStream.format("parquet")
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def drift_monitor(stream: DataFrame, profile: dr.DriftProfile, history_path: str, checkpoint: str,
                  trigger: dict | None = None):
    """One drift cycle per micro-batch against a stored profile (the
    reference itself is not read), kept in ``history_path`` under its batch id.
    A batch that is replayed after a failure overwrites its own record."""
    def cycle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rec = dr.profile_cycle(profile, batch).withColumn("timestamp", F.current_timestamp())
        write_record(rec, history_path, "batch_id", batch_id)

    w = stream.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
