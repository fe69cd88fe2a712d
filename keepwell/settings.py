"""Fixed values shared by the jobs (column lists, dates, costs, thresholds)."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
FEATURES = [
    "recency_days",
    "order_frequency",
    "monetary_total",
    "avg_order_value",
    "total_quantity",
    "customer_tenure_days",
    "avg_freight_value",
    "freight_ratio",
    "category_diversity",
    "avg_review_score",
    "cancelled_orders_cnt",
    "credit_card_share",
    "avg_installments",
    "last_30d_orders",
    "last_60d_orders",
    "spending_trend_velocity",
    "avg_delivery_delay_days",
]
TARGET = "is_churned"

# value a feature takes when the customer has nothing to compute it from
FEATURE_DEFAULTS = {
    "recency_days": 999.0,
    "order_frequency": 1,
    "monetary_total": 0.0,
    "avg_order_value": 0.0,
    "total_quantity": 1,
    "customer_tenure_days": 0.0,
    "avg_freight_value": 0.0,
    "freight_ratio": 0.0,
    "category_diversity": 1,
    "avg_review_score": 4.0,
    "cancelled_orders_cnt": 0,
    "credit_card_share": 0.0,
    "avg_installments": 1.0,
    "last_30d_orders": 0,
    "last_60d_orders": 0,
    "spending_trend_velocity": 0.0,
    "avg_delivery_delay_days": 0.0,
}

INACTIVE_STATUSES = ("canceled", "unavailable")
LEGACY_INACTIVE_STATUSES = ("cancelled",)

RFM_CUTOFF = "2018-05-01"
RFM_NTILE_CUTOFF = "2024-09-01"
HORIZON_DAYS = 90
LOOKBACKS = (180, 365, None)

INCENTIVE_COST = 10.0
SAVED_MARGIN = 120.0
SUCCESS_RATE = 0.20

# what-if screen defaults
ROI_INCENTIVE_COST = 15
ROI_SAVED_MARGIN = 150
ROI_SUCCESS_RATE = 0.25
ROI_THRESHOLD = 0.45

HIGH_RISK = 0.70
MEDIUM_RISK = 0.40

SEED = 42
CV_FOLDS = 5
TUNE_FOLDS = 3
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Snapshot:
    """One point in time at which every customer is described and labelled."""

    name: str
    date: str
    role: str
    horizon_days: int = HORIZON_DAYS


# fixed values: the default chronological panel
SNAPSHOTS = (
    Snapshot("Snapshot 1", "2017-09-01", "train"),
    Snapshot("Snapshot 2", "2017-12-01", "train"),
    Snapshot("Snapshot 3", "2018-03-01", "val"),
    Snapshot("Snapshot 4", "2018-06-01", "test"),
)
