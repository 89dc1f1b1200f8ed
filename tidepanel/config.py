"""Contracts, horizons and thresholds of the price-panel engine."""

from __future__ import annotations

from dataclasses import dataclass, field

# Labels of the sheet's top-level rows and their names in the panel.
COMMODITIES = {
    "Beras": "beras",
    "Cabai Merah": "cabai_merah",
    "Bawang Merah": "bawang_merah",
    "Telur Ayam": "telur_ayam",
    "Minyak Goreng": "minyak_goreng",
    "Daging Ayam": "daging_ayam",
    "Gula Pasir": "gula_pasir",
}

# The sheet's columns that are no dates.
NUMBER_COLUMN, LABEL_COLUMN = "No", "Komoditas (Rp)"

# Column names of the panel, its features and targets, their order, classes and tiers.
CANONICAL_COLUMNS = ["date", "commodity", "price_idr"]
CALENDAR_COLUMNS = ["is_observed_source", "is_month_start", "is_month_end", "year", "month", "week_of_year", "day_of_week"]
TIME_COLUMNS = ["date", "year", "month", "quarter", "day_of_week", "week_of_year"]
LAGS = ["price_lag_1d", "price_lag_7d", "price_lag_30d"]
CHANGES = ["price_change_1d_pct", "price_change_7d_pct", "price_change_30d_pct"]
ROLLING = ["rolling_mean_7d", "rolling_mean_30d", "rolling_std_30d"]
RATIOS = ["price_vs_ma30_pct", "volatility_30d_pct"]
PRICE_FEATURES = LAGS + CHANGES + ROLLING + RATIOS
CYCLES = ["month_sin", "month_cos", "week_sin", "week_cos", "dow_sin", "dow_cos"]
ENGINEERED = ["price_zscore_30d", "ma_gap_7_30_pct", "lag_gap_1_7_pct", "lag_gap_7_30_pct", "momentum_gap_7_30_pct", "volatility_x_momentum"]

CATEGORICAL_FEATURES = ["commodity"]
BINARY_FEATURES = ["is_observed_source", "is_month_start", "is_month_end"]
NUMERIC_FEATURES = ["year", "price_idr", *PRICE_FEATURES, *CYCLES, *ENGINEERED]
MODEL_FEATURES = CATEGORICAL_FEATURES + BINARY_FEATURES + NUMERIC_FEATURES
REQUIRED_COLUMNS = ["date", "commodity", *CALENDAR_COLUMNS, "price_idr", *PRICE_FEATURES]

TARGET_VALUES = {7: "target_7d_inflation_pct", 30: "target_30d_inflation_pct"}
TARGET_CLASSES = {7: "target_7d_class", 30: "target_30d_class"}
CLASSES = ["Deflation", "Stable", "Inflation"]
STABLE_BAND = 1.0
#: The redesigned 30-day label's bounds.
V2_BOUNDS = (-1.4153, 2.0380)
EPSILON = 1e-6

TIERS = {
    "critical": ["price_lag_7d", "price_lag_30d", "rolling_mean_30d", "rolling_std_30d"],
    "important": ["price_change_7d_pct", "price_change_30d_pct", "price_vs_ma30_pct", "volatility_30d_pct"],
}
TIERS["auxiliary"] = [c for c in PRICE_FEATURES if c not in TIERS["critical"] + TIERS["important"]]

INPUT_CONTRACT = "feature_ready_tabular"
MODEL_VERSION = "1.0.0"


@dataclass(frozen=True)
class Lag:
    """The last observation from ``days + slack`` to ``days`` days back."""

    days: int
    slack: int = 0


@dataclass(frozen=True)
class Lead:
    """The first observation from ``days`` to ``days + slack`` days ahead."""

    days: int
    slack: int = 7


@dataclass(frozen=True)
class Rolling:
    """A trailing calendar window of ``days`` days and today, missing below ``min_obs`` observations."""

    days: int
    min_obs: int = 1


# Horizons, their slack and window sizes.
DEFAULT_LAGS = {"1d": Lag(1, 0), "7d": Lag(7, 1), "30d": Lag(30, 2)}
DEFAULT_LEADS = {"7d": Lead(7, 3), "30d": Lead(30, 7)}
DEFAULT_ROLLING = {"mean_7d": Rolling(7, 1), "mean_30d": Rolling(30, 1), "std_30d": Rolling(30, 2)}


@dataclass(frozen=True)
class Bound:
    """Where a rule warns and where it fails: beyond the bound, above it or (``above`` false) below it."""

    warn: float | None = None
    fail: float | None = None
    above: bool = True


# The readiness gate's bounds, by rule and, where it matters, horizon.
BOUNDS = {
    "duplicates": Bound(fail=0),
    "null_prices": Bound(fail=0.01),
    "non_positive_prices": Bound(fail=0.0),
    "unexpected": Bound(fail=0),
    "missing_days": Bound(0.35, 0.6),
    "critical_feature": Bound(0.55, 0.35, above=False),
    "model_rows": Bound(warn=0.4, above=False),
    "target_rate_low": Bound(warn=0.25, above=False),
    "target_rate_least": Bound(fail=0.2, above=False),
    "trainable 7d": Bound(fail=20, above=False),
    "trainable 30d": Bound(fail=12, above=False),
    "trainable_total 7d": Bound(fail=50, above=False),
    "trainable_total 30d": Bound(fail=30, above=False),
    "span 7d": Bound(fail=45, above=False),
    "span 30d": Bound(fail=60, above=False),
    "classes": Bound(fail=2, above=False),
    "class_ratio": Bound(0.05, 0.01, above=False),
    "tolerance": Bound(0.5, 0.8),
    "no_match": Bound(warn=0.8),
    "p90_change": Bound(50.0, 150.0),
    "max_to_median": Bound(20.0, 50.0),
    "flat": Bound(21, 45),
    "jumps": Bound(8.0, 15.0),
}


@dataclass(frozen=True)
class DiagnosticsConfig:
    """``bounds`` replaces some of ``BOUNDS``; the rest stays."""

    bounds: dict[str, Bound] = field(default_factory=dict)
    allowed_commodities: tuple[str, ...] | None = None
    stable_band: float = STABLE_BAND

    def bound(self, rule: str) -> Bound:
        return self.bounds.get(rule, BOUNDS[rule])


def artifact_root(root, horizon: int) -> str:
    """Where the versions of a horizon's artifact lie; ``root`` may be a URI."""
    return f"{str(root).rstrip('/')}/direction_{horizon}d"


def model_path(version: str) -> str:
    return f"{version}/model"


def metadata_path(version: str) -> str:
    return f"{version}/metadata.json"
