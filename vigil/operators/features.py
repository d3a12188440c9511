"""Causal per-customer features (W1-W5), encoders (A1-A4) and lookups.

Plan shape: the transaction table is hash-partitioned once on the feature
keys (``split`` + customer, or customer alone) and every per-customer window
(recency, velocity, device first-seen, running device count) runs on that one
exchange. Known devices travel with the data as marker rows instead of being
joined on (customer, device), which would need a second shuffle. Encoder maps
are joined after the windows, broadcast only when their row count is checked
to be small.

Tie rule: the order within a customer is (ts, transaction_id); a row sees
earlier rows with the same timestamp but not later ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import FIRST_TXN_SENTINEL, ROLES, TARGET_SMOOTHING, FeatureConfig
from vigil.functions.columns import micros
from vigil.operators.joins import kept, lookup_join

US = "_us"
# amounts are summed with nine decimals, up to 1e29
AMOUNT_TYPE = "decimal(38,9)"


def with_micros(tx: DataFrame, ts: str = ROLES.ts) -> DataFrame:
    return tx if US in tx.columns else tx.withColumn(US, micros(ts))


def _keys(partition_keys) -> list[str]:
    return list(partition_keys) if partition_keys else [ROLES.customer]


# --------------------------------------------------------------------------
# W1 recency
# --------------------------------------------------------------------------
def recency_column(partition_keys=None) -> F.Column:
    w = Window.partitionBy(*_keys(partition_keys)).orderBy(US, ROLES.transaction_id)
    prev = F.lag(US).over(w)
    return F.coalesce((F.col(US) - prev) / F.lit(1e6), F.lit(FIRST_TXN_SENTINEL))


def add_recency(tx: DataFrame, partition_keys=None) -> DataFrame:
    tx = with_micros(tx)
    return tx.withColumn("seconds_since_last_txn", recency_column(partition_keys))


# --------------------------------------------------------------------------
# W2/W3 velocity: prior rows in (t - w, t]
# --------------------------------------------------------------------------
def velocity_totals(partition_keys=None, amount: str = ROLES.amount) -> dict[str, F.Column]:
    """Counts and sums of a key's earlier rows, in (ts, id) order, and of all
    its rows up to the row's time."""
    keys = _keys(partition_keys)
    fixed = F.col(amount).cast(AMOUNT_TYPE)
    by_row = Window.partitionBy(*keys).orderBy(US, ROLES.transaction_id).rowsBetween(Window.unboundedPreceding, -1)
    by_time = Window.partitionBy(*keys).orderBy(US).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = {}
    for name, frame in (("before", by_row), ("upto", by_time)):
        out[f"_{name}_n"] = F.count(amount).over(frame)
        out[f"_{name}_s"] = F.coalesce(F.sum(fixed).over(frame), F.lit(0).cast(AMOUNT_TYPE))
    return out


def velocity_columns(windows_minutes, partition_keys=None) -> dict[str, F.Column]:
    """Earlier rows in (t - w, t] are all earlier rows, less those up to t - w:
    what ``velocity_totals`` has at the last row up to t - w (rows of one time
    have one total, so any of them does). Nothing is summed again per window,
    and the cost is linear in a key's rows whatever the window holds. Rows without
    a time come first and have no rows that are too old. Amounts are summed as
    fixed-point numbers (as in the skew plan), so differences are exact."""
    by_time = Window.partitionBy(*_keys(partition_keys)).orderBy(US)
    out = {}
    for w in windows_minutes:
        old = by_time.rangeBetween(Window.unboundedPreceding, -int(w) * 60 * 1_000_000)
        n, total = (F.when(F.col(US).isNotNull(), F.last(c).over(old)) for c in ("_upto_n", "_upto_s"))
        out[f"velocity_count_{w}m"] = (F.col("_before_n") - F.coalesce(n, F.lit(0))).cast("bigint")
        total = F.coalesce(total, F.lit(0).cast(AMOUNT_TYPE))
        out[f"velocity_amount_{w}m"] = F.greatest((F.col("_before_s") - total).cast("double"), F.lit(0.0))
    return out


def add_velocity(tx: DataFrame, windows_minutes, partition_keys=None) -> DataFrame:
    tx = with_micros(tx)
    if not windows_minutes:
        return tx
    totals = velocity_totals(partition_keys)
    return tx.withColumns(totals).withColumns(velocity_columns(windows_minutes, partition_keys)).drop(*totals)


# --------------------------------------------------------------------------
# A1-A3 target encoding, J1/J2 lookups
# --------------------------------------------------------------------------
@dataclass
class RiskMaps:
    merchant: DataFrame      # merchant_id, merchant_risk_score
    category: DataFrame      # merchant_category, merchant_category_risk_score
    global_mean: float


def fit_risk_maps(train: DataFrame, smoothing: float = TARGET_SMOOTHING,
                  label: str = ROLES.label) -> RiskMaps:
    """Smoothed merchant rate (mean*cnt + g*s)/(cnt + s); unsmoothed category
    mean. Grouped aggregates with map-side partial aggregation: a hot merchant
    costs one partial row per task, not a skewed reducer. The global rate g
    comes from the (checkpointed) per-merchant sums, not another scan."""
    per_m = kept(train.groupBy(ROLES.merchant).agg(F.sum(label).alias("_s"), F.count(label).alias("_n")))
    tot = per_m.agg(F.sum("_s").alias("s"), F.sum("_n").alias("n")).first()
    g = float(tot["s"]) / tot["n"] if tot["n"] else 0.0
    mean = F.col("_s") / F.col("_n")
    merchant = per_m.select(
        ROLES.merchant,
        ((mean * F.col("_n") + F.lit(g) * F.lit(smoothing)) / (F.col("_n") + F.lit(smoothing)))
        .alias("merchant_risk_score"))
    category = (train.groupBy(ROLES.category)
                .agg(F.avg(label).alias("merchant_category_risk_score")))
    return RiskMaps(merchant, category, g)


def apply_risk_maps(tx: DataFrame, maps: RiskMaps, merchant_override: str | None = None) -> DataFrame:
    """Left lookups with the global mean as default. ``merchant_override``
    names a caller-supplied score column that wins over the lookup (P9)."""
    out = lookup_join(tx, maps.merchant, ROLES.merchant)
    out = lookup_join(out, maps.category, ROLES.category)
    m = F.coalesce(F.col("merchant_risk_score"), F.lit(maps.global_mean))
    if merchant_override:
        m = F.coalesce(F.col(merchant_override), m)
    return out.withColumns({
        "merchant_risk_score": m,
        "merchant_category_risk_score": F.coalesce(F.col("merchant_category_risk_score"),
                                                   F.lit(maps.global_mean)),
    })


# --------------------------------------------------------------------------
# A4 / J3 / W4 / W5 device consistency
# --------------------------------------------------------------------------
def fit_known_devices(train: DataFrame) -> DataFrame:
    """Distinct (customer, device) pairs of the fitting data, one row each."""
    return train.select(ROLES.customer, ROLES.device).distinct()


def add_device_consistency(tx: DataFrame, known: DataFrame | None = None,
                           partition_keys=None, split_values=None) -> DataFrame:
    """is_new_device: the device is neither known nor seen earlier for this
    customer (in this partition). distinct_device_count_so_far: known count
    plus new devices up to and including this row."""
    keys = _keys(partition_keys)
    data = with_marker_rows(with_micros(tx), known, keys, split_values)
    return _device_windows(data, keys)


def with_marker_rows(tx: DataFrame, known: DataFrame | None, keys, split_values) -> DataFrame:
    data = tx.withColumn("_marker", F.lit(0))
    if known is None:
        return data
    m = known.select(ROLES.customer, ROLES.device).withColumn("_marker", F.lit(1))
    # known pairs replicated once per split value (bounded: #splits copies)
    # so each (split, customer) partition holds its customer's known devices
    for k in keys:
        if k == ROLES.customer:
            continue
        if split_values is None:
            raise ValueError("split_values is required when partitioning by " + k)
        m = m.withColumn(k, F.explode(F.array(*[F.lit(v) for v in split_values])))
    return data.unionByName(m, allowMissingColumns=True)


def _device_windows(data: DataFrame, keys) -> DataFrame:
    """Over a frame that holds data rows (``_marker`` = 0) and known-device marker
    rows (``_marker`` = 1) in the same partitions. The finest order comes first,
    so the windows over devices share one sort; then the markers go, and those
    over time share another."""
    first_seen = Window.partitionBy(*keys, ROLES.device, "_marker").orderBy(US, ROLES.transaction_id)
    data = data.withColumn("_nth", F.row_number().over(first_seen))
    marks = F.when(F.col("_nth") == 1, F.col("_marker")).otherwise(0)  # a pair counts once
    data = data.withColumns({"_here": F.max(marks).over(Window.partitionBy(*keys, ROLES.device)),
                             "_known": F.sum(marks).over(Window.partitionBy(*keys))})
    data = data.where(F.col("_marker") == 0).withColumn(
        "is_new_device", ((F.col("_nth") == 1) & (F.col("_here") == 0)).cast("int")).drop("_marker", "_nth", "_here")
    running = (Window.partitionBy(*keys).orderBy(US, ROLES.transaction_id)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return data.withColumn("distinct_device_count_so_far",
                           (F.col("_known") + F.sum("is_new_device").over(running)).cast("bigint")).drop("_known")


# --------------------------------------------------------------------------
# Composition: all window features on one exchange
# --------------------------------------------------------------------------
def causal_features(tx: DataFrame, cfg: FeatureConfig = FeatureConfig(),
                    known: DataFrame | None = None, partition_keys=None,
                    split_values=None, hot_key_rows: int | None = None) -> DataFrame:
    """W1-W5. Keys with more than ``hot_key_rows`` rows (default
    ``hotkeys.HOT_KEY_ROWS``; found by a partially aggregated count) take the
    range-partitioned prefix-sum plan of ``vigil.operators.hotkeys``; all
    other keys take the hash-partitioned window plan below. ``hot_key_rows=-1``
    sends every key through the skew plan."""
    from vigil.operators import hotkeys as hk
    keys = _keys(partition_keys)
    tx = with_micros(tx)
    threshold = hk.HOT_KEY_ROWS if hot_key_rows is None else hot_key_rows
    hot, n_rows = hk.find_hot_keys(tx, keys, threshold)
    if hot is None:
        return _window_features(tx, cfg, known, keys, split_values, n_rows)
    cold_tx, hot_tx = hk.split_hot(tx, hot, keys)
    cold = _window_features(cold_tx, cfg, known, keys, split_values, n_rows)
    markers = None
    if known is not None:
        m = with_marker_rows(hot_tx.limit(0), known, keys, split_values).where(F.col("_marker") == 1)
        markers = hk.split_hot(m.select(*keys, ROLES.device), hot, keys)[1]
    hot_out = hk.range_features(hot_tx, cfg.windows_minutes, keys, markers)
    return cold.unionByName(hot_out.select(*cold.columns))


#: rows of a feature task: what a task holds does not grow with the table
TASK_ROWS = 100_000


def _window_features(tx: DataFrame, cfg: FeatureConfig, known: DataFrame | None, keys,
                     split_values, n_rows: int) -> DataFrame:
    """Hash plan: marker rows are added before the single explicit
    repartition on the keys; every window's partition spec contains the keys,
    so all of them reuse that one exchange. Marker rows are gone before recency
    and velocity. Columns that no window reads travel as one struct, which is
    copied as it is. Where ``n_rows`` make more tasks than slots, the number of
    tasks follows the rows; below, Spark merges small partitions."""
    read = [*keys, US, ROLES.transaction_id, ROLES.amount, ROLES.device]
    rest = [c for c in tx.columns if c not in read]
    packed = tx.select(*read, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest")) if rest else tx
    data = with_marker_rows(packed, known, keys, split_values)
    tasks = -(-n_rows // TASK_ROWS)
    many = [tasks] if tasks > tx.sparkSession.sparkContext.defaultParallelism else []
    data = _device_windows(data.repartition(*many, *[F.col(k) for k in keys]), keys)
    data = add_velocity(add_recency(data, keys), cfg.windows_minutes, keys)
    # taken from a condition, the fields are not pulled below the sorts one by one
    whole = F.when(F.col("_rest").isNotNull(), F.col("_rest")) if rest else None
    own = [whole[c].alias(c) if c in rest else F.col(c) for c in tx.columns]
    return data.select(*own, "seconds_since_last_txn", *cfg.velocity_columns(), "is_new_device", "distinct_device_count_so_far")


def causal_merchant_risk(tx: DataFrame, global_mean: float, smoothing: float = TARGET_SMOOTHING,
                         label: str = ROLES.label, out: str = "merchant_risk_score") -> DataFrame:
    """Q5 option: the smoothed rate from the merchant's *earlier* rows only,
    (sum_prior + g*s) / (n_prior + s), in (ts, id) order. Prefix sums along
    (merchant, ts, id) come from range-partitioned blocks, so a merchant with
    a third of all rows is spread over many tasks; the merchant's starting
    offset is the minimum of its (non-decreasing) exclusive prefix, a
    partially aggregated min joined back by merchant."""
    from vigil.operators.order import with_running_sums
    tx = with_micros(tx)
    order = [F.col(ROLES.merchant), F.col(US), F.col(ROLES.transaction_id)]
    lab = F.coalesce(F.col(label).cast("long"), F.lit(0))
    has = F.col(label).isNotNull().cast("long")
    run = with_running_sums(tx, order, {"_ps": lab, "_pn": has}, inclusive=False)
    start = run.groupBy(ROLES.merchant).agg(F.min("_ps").alias("_s0"), F.min("_pn").alias("_n0"))
    run = lookup_join(run, start, ROLES.merchant, how="inner")
    s_prior = F.col("_ps") - F.col("_s0")
    n_prior = F.col("_pn") - F.col("_n0")
    score = (s_prior + F.lit(global_mean) * F.lit(smoothing)) / (n_prior + F.lit(smoothing))
    return run.withColumn(out, score).drop("_ps", "_pn", "_s0", "_n0")
