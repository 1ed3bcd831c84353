"""Immutable settings of the jobs."""

from __future__ import annotations

from dataclasses import dataclass

# The customer schema that events are normalised to, and its roles.
CANONICAL_FIELDS = (
    "customer_id", "gender", "senior", "tenure_months", "monthly_charges",
    "total_charges", "contract", "payment_method", "num_services", "churn",
)
NUMERIC_FEATURES = ("tenure_months", "monthly_charges", "total_charges", "num_services")
CATEGORICAL_FEATURES = ("gender", "senior", "contract", "payment_method")


@dataclass(frozen=True)
class MonitorConfig:
    """Thresholds of the drift monitor."""

    # The monitor's seed, limits and group size.
    seed: int = 42
    psi_warning: float = 0.10
    psi_danger: float = 0.25
    js_warning: float = 0.005
    js_danger: float = 0.020
    missing_warning_pp: float = 2.0
    min_group_size: int = 80
    top_causes: int = 6
    high_risk_threshold: float = 0.50
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    first_target: str = "monthly_charges"


@dataclass(frozen=True)
class ConcurrencyConfig:
    """Range and limits of the adaptive concurrency decision."""

    initial: int = 10
    low: int = 1
    high: int = 30
    latency_limit_ms: float = 100.0
    failure_limit: float = 0.2
    retry_limit: float = 0.2
    calm_share: float = 0.75
    step: int = 2
