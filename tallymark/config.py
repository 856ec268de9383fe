"""Audit thresholds, passed to every operator that needs one."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Names that appear in result columns.
RULE_NAMES = {
    1: "Exact Duplicate Invoice",
    2: "Near-Duplicate Invoice",
    3: "Split Purchase Order",
    4: "Three-Way Match Failure",
    5: "Maverick Buying",
    6: "After-Hours Transaction",
    7: "Budget Overrun",
    8: "Round Number Invoice",
    9: "New Vendor Fast Payment",
}
TIERS = ("Critical", "High", "Medium", "Low")
FEATURES = (
    "feat_amount_zscore",
    "feat_invoice_to_po_ratio",
    "feat_vendor_age_days",
    "feat_days_to_payment",
    "feat_vendor_monthly_freq",
    "feat_pct_of_cc_budget",
    "feat_after_hours",
    "feat_no_po",
    "feat_round_number",
    "feat_benford_dev",
)
ANOMALY_FLAGS = (
    "is_duplicate",
    "is_near_duplicate",
    "is_match_failure",
    "is_maverick",
    "is_after_hours",
    "is_round_number",
    "is_ghost_vendor_inv",
)


@dataclass(frozen=True)
class AuditConfig:
    """Tunable thresholds. Money and ratios are decimals so that a value on
    the border is decided exactly."""

    match_tolerance: Decimal = Decimal("0.05")
    match_severe: Decimal = Decimal("0.20")
    approval_threshold: Decimal = Decimal("100000.00")
    split_window_days: int = 30
    biz_hour_start: int = 8
    biz_hour_end: int = 19
    new_vendor_days: int = 7
    dup_amount_tolerance: Decimal = Decimal("0.02")
    dup_amount_epsilon: Decimal = Decimal("0.01")
    dup_date_window_days: int = 30
    budget_severe: Decimal = Decimal("0.20")
    round_moduli: tuple[int, ...] = (1000, 5000, 10000, 50000, 100000)

    # weights and cut-offs of the composite score
    weight_ml: float = 0.40
    weight_rule: float = 0.35
    weight_value: float = 0.25
    tier_critical: float = 75.0
    tier_high: float = 55.0
    tier_medium: float = 35.0
    strong_outlier: float = 70.0

    # anomaly models
    contamination: float = 0.05
    forest_trees: int = 200
    forest_sample: int = 256
    seed: int = 42
    weight_forest: float = 0.55
    weight_autoencoder: float = 0.45
    # rows per model copy in data-parallel training; the number of copies follows the data
    rows_per_worker: int = 10_000


DEFAULT = AuditConfig()
