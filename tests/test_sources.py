"""Sources and sinks: adapters, schema checks, history tables, reports."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from vigil.operators.drift import usable_features
from vigil.session import shared_dir
from vigil.sources.adapters import MissingColumnsError, require_columns, transactions_from_events
from vigil.sources.history import append_history, load_history, write_report
from vigil.sources.tables import read_table

HIST = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("cycle", T.StringType()),
                     T.StructField("n_significant_features", T.LongType()),
                     T.StructField("drift_alert", T.BooleanType())])


def test_require_columns_lists_all_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(MissingColumnsError) as e:
        require_columns(df, ["a", "x", "y"])
    assert "['x', 'y']" in str(e.value)


def test_usable_features_intersection(spark):
    a = spark.createDataFrame([(1, 2)], "f1 int, f2 int")
    b = spark.createDataFrame([(1, 2)], "f2 int, f3 int")
    assert usable_features(a, b, ["f1", "f2", "f3"]) == ["f2"]


def test_history_append_and_load(spark):
    path = shared_dir(spark, f"hist-{uuid.uuid4().hex[:8]}")
    assert load_history(spark, path, HIST).count() == 0          # missing history is empty
    rec = spark.createDataFrame([(None, "drift", 4, True)], HIST).withColumn("timestamp", F.current_timestamp())
    append_history(rec, path)
    append_history(rec.withColumn("drift_alert", F.lit(False)), path)
    h = load_history(spark, path, HIST)
    assert h.count() == 2 and h.columns == HIST.fieldNames()


def test_report_sinks(spark):
    path = shared_dir(spark, f"rep-{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([("m", 0.5)], "model string, pr_auc double")
    write_report(df, path + "/json")
    write_report(df, path + "/csv", fmt="csv")
    assert spark.read.json(path + "/json").first()["pr_auc"] == 0.5
    assert spark.read.option("header", True).csv(path + "/csv").count() == 1


def test_events_adapter_schema(spark):
    tx = transactions_from_events(read_table(spark, SF_SMALL, "events"))
    assert tx.columns == ["transaction_id", "customer_id", "merchant_id", "merchant_category", "device_id",
                          "ts", "amount", "label"]
    assert tx.where(F.col("transaction_id").isNull()).count() == 0


def test_csv_reader_declared_schema_and_time_offset(spark):
    from vigil.sources.tables import read_csv_transactions
    path = shared_dir(spark, f"csv-{uuid.uuid4().hex[:8]}")
    ev = read_table(spark, SF_SMALL, "events").select(
        "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 -
                     F.unix_micros(F.lit("2024-01-01").cast("timestamp")) / 1e6).alias("Time"), "value")
    ev.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("Time", T.DoubleType()),
                           T.StructField("value", T.DoubleType())])
    back = read_csv_transactions(spark, path, schema)
    orig = read_table(spark, SF_SMALL, "events").select("event_id", F.col("ts").alias("ts0"))
    j = back.join(orig, "event_id")
    assert j.count() == orig.count()
    assert j.where(F.abs(F.unix_micros(F.col("ts").cast("timestamp")) -
                         F.unix_micros(F.col("ts0").cast("timestamp"))) > 1).count() == 0
