"""Fixed values and column-role configuration.

Every number below is a fixed value that must equal the behaviour being
reproduced; operators take them as parameters with these defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must not change: results depend on them)
# --------------------------------------------------------------------------
FIRST_TXN_SENTINEL = 1e6            # seconds since last txn when there is none
DEFAULT_WINDOWS_MINUTES = (10, 60, 1440)
TARGET_SMOOTHING = 20.0             # merchant target-encoding prior weight
TRAIN_FRAC = 0.7
VAL_FRAC = 0.15
PSI_BINS = 10
PSI_FLOOR = 1e-6                    # bin shares are clipped at this floor
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
FLAG_THRESHOLD = 0.5
MIN_SIGNIFICANT_FEATURES = 3        # drift alert when this many features shift
DRIFT_TOP_K = 5
REALIZED_F1_FLOOR = 0.05
REALIZED_RECALL_FLOOR = 0.30
DECAY_F1_ABS_FLOOR = 0.05
DECAY_F1_RELATIVE_DROP = 0.25
DRIFT_SUSTAINED_CYCLES = 2
DRIFT_MIN_SIGNIFICANT_FEATURES = 3
PRIMARY_METRIC = "pr_auc"
PROMOTION_MIN_GAIN = 0.005
CHALLENGER_WINDOW_FRAC = 0.5
HIGH_RECALL_MIN_PRECISION = 0.30
F1_TUNING_EPS = 1e-12
SMOTE_TARGET_RATIO = 0.10
SMOTE_K = 5
GLOBAL_TOP_N = 15
ROW_TOP_N = 8
DEVICE_TTL_DAYS = 90
RANDOM_STATE = 42
STAGE_STAGING = "Staging"
STAGE_PRODUCTION = "Production"
STAGE_ARCHIVED = "Archived"
EFFECT_UP = "increased fraud risk"        # per-row explanation wording
EFFECT_DOWN = "decreased fraud risk"


@dataclass(frozen=True)
class Roles:
    """Column roles of the canonical transaction table."""

    transaction_id: str = "transaction_id"
    customer: str = "customer_id"
    merchant: str = "merchant_id"
    category: str = "merchant_category"
    device: str = "device_id"
    ts: str = "ts"
    amount: str = "amount"
    label: str = "label"


ROLES = Roles()


@dataclass(frozen=True)
class FeatureConfig:
    windows_minutes: tuple = DEFAULT_WINDOWS_MINUTES
    smoothing: float = TARGET_SMOOTHING
    # "per_split": features restart in every split (reference behaviour);
    # "continuous": one history per customer across splits.
    scope: str = "per_split"
    roles: Roles = field(default_factory=Roles)
    # columns of the source that are model inputs as they are
    raw_inputs: tuple = ()

    def velocity_columns(self) -> list[str]:
        cols = []
        for w in self.windows_minutes:
            cols += [f"velocity_count_{w}m", f"velocity_amount_{w}m"]
        return cols

    def feature_columns(self, extra_leading: tuple = ()) -> list[str]:
        """Ordered model input columns (leading raw columns, then amount,
        recency, velocities, encodings, device consistency)."""
        return (list(extra_leading) + list(self.raw_inputs)
                + [self.roles.amount, "seconds_since_last_txn"]
                + self.velocity_columns()
                + ["merchant_risk_score", "merchant_category_risk_score",
                   "is_new_device", "distinct_device_count_so_far"])
