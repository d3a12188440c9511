"""A customer holding a third of all rows: the skew plan gives the same
features as the per-customer window plan, and its blocks stay balanced."""

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.config import FeatureConfig, ROLES
from vigil.operators import features as fe
from vigil.operators.hotkeys import range_features
from vigil.operators.order import BLOCK, range_blocks
from vigil.operators.split import SPLITS, time_split
from vigil.plans.feature_pipeline import build_features
from vigil.plans.q_features import events_tx

W = (10, 60, 1440, 10080)
COLS = ["seconds_since_last_txn", "is_new_device", "distinct_device_count_so_far"] + \
    FeatureConfig(windows_minutes=W).velocity_columns()


def skewed(spark):
    tx = events_tx(spark, SF_SMALL)
    return tx.withColumn("customer_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0))
                         .otherwise(F.col("customer_id")))


def test_hot_key_plan_equals_window_plan(spark):
    st, _ = time_split(skewed(spark))
    known = fe.fit_known_devices(st.where(F.col("split") == "train"))
    keys = ["split", ROLES.customer]
    cfg = FeatureConfig(windows_minutes=W)
    a = fe.causal_features(st, cfg, known, keys, list(SPLITS), hot_key_rows=10**9)
    b = fe.causal_features(st, cfg, known, keys, list(SPLITS), hot_key_rows=100)   # only customer 0 is hot
    pa = a.select("transaction_id", *COLS).toPandas().set_index("transaction_id").sort_index()
    pb = b.select("transaction_id", *COLS).toPandas().set_index("transaction_id").sort_index()
    pd.testing.assert_frame_equal(pa.astype(float), pb.astype(float), rtol=1e-9, atol=1e-6)


def test_range_blocks_split_a_hot_key(spark):
    tx = fe.with_micros(skewed(spark)).select("customer_id", "_us", "transaction_id")
    blocked = range_blocks(tx, ["customer_id", "_us", "transaction_id"], n_blocks=8)
    sizes = [r[1] for r in blocked.groupBy(BLOCK).count().collect()]
    assert max(sizes) < 2.5 * (sum(sizes) / 8)          # the hot customer does not make one block
    hot_blocks = blocked.where(F.col("customer_id") == 0).select(BLOCK).distinct().count()
    assert hot_blocks >= 2


def _odd(spark):
    """String keys and ids; a third on one key, a third on a null key; ties,
    a null amount, a null device, an extra column."""
    tx = events_tx(spark, SF_SMALL)
    i = F.col("transaction_id")
    return fe.with_micros(tx.withColumns({
        "customer_id": F.when(i % 3 == 0, F.lit("C0")).when(i % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("U"), F.col("customer_id") % 5)),
        "transaction_id": F.concat(F.lit("T"), F.reverse(i.cast("string")), F.lit("-"), i),
        "ts": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "extra": F.lit("mine"),
        "amount": F.when(i % 17 != 0, F.col("amount")), "device_id": F.when(i % 29 != 0, F.col("device_id"))}))


def test_string_and_null_keys(spark):
    """Blocks of a few rows against the window plan, with and without known devices."""
    tx = _odd(spark)
    cfg = FeatureConfig(windows_minutes=W)
    for known in (None, fe.fit_known_devices(tx.where("ts < '2024-01-05'"))):
        a = fe.causal_features(tx, cfg, known, hot_key_rows=10**9)
        want = {r.transaction_id: r for r in a.select("transaction_id", *COLS).collect()}
        for blocks in (1, 40):
            got = range_features(tx, W, ["customer_id"], known, blocks).collect()
            assert len(got) == len(want) and {r.extra for r in got} == {"mine"}
            for r in got:
                assert tuple(r[c] for c in COLS) == tuple(want[r.transaction_id][c] for c in COLS), r
        mixed = fe.causal_features(tx, cfg, known, hot_key_rows=150).select("transaction_id", *COLS).collect()
        assert {r.transaction_id: r for r in mixed} == want


def test_plan_has_one_range_shuffle_of_rows_and_no_join_back(spark):
    plan = range_features(_odd(spark), W, ["customer_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # after the sorted blocks rows leave as they come


def test_feature_tasks_follow_the_rows(spark, monkeypatch):
    """The windows' tasks grow with the table instead of their memory, two
    sorts serve all of them, and the features stay the same."""
    tx = events_tx(spark, SF_SMALL)
    cfg = FeatureConfig(windows_minutes=W)
    want = build_features(tx, cfg).features.orderBy("transaction_id").collect()
    monkeypatch.setattr(fe, "TASK_ROWS", 50)
    many = build_features(tx, cfg).features
    assert many._jdf.queryExecution().executedPlan().toString().count("Sort [split") == 2
    assert many.rdd.getNumPartitions() == -(-tx.count() // 50)
    got = many.orderBy("transaction_id").collect()
    for a, b in zip(want, got, strict=True):
        assert [round(v, 9) if isinstance(v, float) else v for v in a] == [round(v, 9) if isinstance(v, float) else v for v in b]
