"""Settings as frozen dataclasses, so a test can scale a threshold without patching."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DetectorConfig:
    """Thresholds of the window detectors. The defaults."""

    width: str = "5 minutes"

    revenue_baseline: float = 50.0
    revenue_drop: float = 0.30
    revenue_drop_high: float = 0.40
    revenue_drop_critical: float = 0.50

    traffic_min: int = 1000
    traffic_max: int = 2000
    traffic_low_high: int = 750
    traffic_low_critical: int = 500
    traffic_peak_high: int = 2500
    traffic_peak_critical: int = 3000

    cart_min_adds: int = 5
    abandonment_expected: float = 0.50
    abandonment_max: float = 0.70
    abandonment_high: float = 0.80
    abandonment_critical: float = 0.90

    conversion_min_users: int = 20
    conversion_min: float = 0.03
    conversion_high: float = 0.02
    conversion_critical: float = 0.01

    missing_price: float = 0.10
    missing_price_high: float = 0.25
    missing_price_critical: float = 0.50

    category_min_purchases: int = 10
    category_dominance: float = 0.60
    category_expected_pct: int = 25


@dataclass(frozen=True)
class BaselineConfig:
    """Rolling baseline over the windows before the current one."""

    windows: int = 12
    traffic_sigma: tuple[float, float, float] = (3.0, 4.0, 5.0)  # medium, high, critical
    abandonment_sigma: float = 2.5
    abandonment_rate: float = 0.70
    revenue_drop: tuple[float, float, float] = (0.30, 0.40, 0.50)


@dataclass(frozen=True)
class AlertConfig:
    severities: tuple[str, ...] = ("critical", "high")
    dashboard_url: str = "https://dashboards.example/overview"
    dedup_window: str = "15 minutes"


@dataclass(frozen=True)
class StreamConfig:
    fast_watermark: str = "2 minutes"
    anomaly_watermark: str = "10 minutes"
    minute: str = "1 minute"
    trigger: str = "30 seconds"
    # Streaming state is bound to this number for the life of a checkpoint.
    state_partitions: int = 200


@dataclass(frozen=True)
class SessionConfig:
    gap: str = "30 minutes"
    # Width of the pieces a user's timeline is cut into, so that no task holds a whole user.
    chunk: str = "minute"
