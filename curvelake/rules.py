"""Rules that drive every stage, as plain frozen objects.

The numbers and names below are fixed values that published results depend on.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Supported statistics, in publishing order.
TARGET_STATS = (
    "passing_yards",
    "passing_touchdowns",
    "rushing_yards",
    "rushing_touchdowns",
    "receiving_yards",
    "receiving_touchdowns",
    "receptions",
)

# Accepted input headers per canonical weekly-history column.
WEEKLY_HEADERS = {
    "gsis_player_id": ("gsis_player_id", "player_id"),
    "player_name": ("player_display_name", "player_name"),
    "team": ("team", "recent_team"),
    "position": ("position",),
    "passing_attempts": ("passing_attempts", "attempts"),
    "rushing_attempts": ("rushing_attempts", "carries"),
    "targets": ("targets",),
    "passing_yards": ("passing_yards",),
    "passing_touchdowns": ("passing_touchdowns", "passing_tds"),
    "rushing_yards": ("rushing_yards",),
    "rushing_touchdowns": ("rushing_touchdowns", "rushing_tds"),
    "receiving_yards": ("receiving_yards",),
    "receiving_touchdowns": ("receiving_touchdowns", "receiving_tds"),
    "receptions": ("receptions",),
}
OPTIONAL_HEADERS = {"age": ("age",), "experience": ("experience", "years_exp")}


@dataclass(frozen=True)
class PowerFitRules:
    """Rolling Poisson power calibration of raw baselines."""

    minimum_seasons: int = 3
    exponent_bounds: tuple[float, float] = (0.25, 3.0)
    half_life_candidates: tuple[float, ...] = (1.0, 3.0, 5.0, 10.0)
    minimum_validation_seasons: int = 3
    method: str = "rolling_power_poisson"


@dataclass(frozen=True)
class HistoryRules:
    """Which statistics exist, how exposure is measured, and how lags are blended."""

    stats: tuple[str, ...] = TARGET_STATS
    opportunity_by_stat: Mapping[str, str] = field(default_factory=lambda: {
        "passing_yards": "passing_attempts",
        "passing_touchdowns": "passing_attempts",
        "rushing_yards": "rushing_attempts",
        "rushing_touchdowns": "rushing_attempts",
        "receiving_yards": "targets",
        "receiving_touchdowns": "targets",
        "receptions": "targets",
    })
    minimum_opportunity: Mapping[str, float] = field(default_factory=lambda: {
        "passing_attempts": 100.0, "rushing_attempts": 25.0, "targets": 25.0,
    })
    signed_stats: frozenset[str] = frozenset({"passing_yards", "rushing_yards", "receiving_yards"})
    plausible_maximum: Mapping[str, float] = field(default_factory=lambda: {
        "passing_yards": 8000.0, "passing_touchdowns": 100.0, "rushing_yards": 4000.0,
        "rushing_touchdowns": 50.0, "receiving_yards": 4000.0, "receiving_touchdowns": 50.0,
        "receptions": 300.0,
    })
    # (first season, scheduled games): a step function of the season.
    schedule: tuple[tuple[int, int], ...] = ((1999, 16), (2021, 17))
    reference_games: int = 17
    season_type: str = "REG"
    ingest_start_season: int = 1999
    calibration_start_season: int = 2011
    latest_completed_season: int = 2024
    prior_seasons: int = 3
    recency_half_life_seasons: float = 5.0
    minimum_training_seasons: int = 2
    holdout_seasons: int = 3
    minimum_player_seasons_per_stat: int = 200
    power_fit: PowerFitRules = PowerFitRules()

    @property
    def opportunities(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.opportunity_by_stat[stat] for stat in self.stats))

    @property
    def holdout_start(self) -> int:
        return self.latest_completed_season - self.holdout_seasons + 1


@dataclass(frozen=True)
class CalibrationRules:
    """Historical dispersion fitting, bootstrap, and holdout tolerances."""

    dispersion_bounds: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {stat: (0.05, 1000.0) for stat in TARGET_STATS})
    sensitivity_start_seasons: tuple[int, ...] = (2011, 2016, 2021)
    bootstrap_samples: int = 500
    bootstrap_confidence_level: float = 0.90
    minimum_bootstrap_success_rate: float = 0.90
    random_seed: int = 20260825
    minimum_holdout_player_seasons_per_stat: int = 30
    minimum_sensitivity_player_seasons_per_stat: int = 25
    brier_event_cdf_levels: tuple[float, ...] = (0.25, 0.50, 0.75)
    interval_levels: tuple[float, ...] = (0.50, 0.80, 0.90)
    mean_calibration_bins: int = 10
    max_holdout_nll_regret_per_player_season: float = 0.05
    max_brier_calibration_gap: float = 0.10
    max_interval_coverage_error: float = 0.10
    max_abs_relative_bias: float = 0.10
    max_sensitivity_log_dispersion_delta: float = 1.0
    calibration_version: str = "negative_binomial_historical_v2"


@dataclass(frozen=True)
class SourceRules:
    """One quote source: ``book`` sources quote two sides, ``contract`` sources quote thresholds."""

    kind: str
    enabled: bool = True
    weight: float = 1.0


# Quote sources, their kind and consensus weight.
SOURCES = {
    "draftkings": SourceRules("book", True, 1.0),
    "fanduel": SourceRules("book", True, 1.0),
    "kalshi": SourceRules("contract", True, 0.0),
}


@dataclass(frozen=True)
class PricingRules:
    probability_tolerance: float = 1e-9
    reject_ambiguous_integer_lines: bool = True
    max_spread_probability_points: float = 20.0
    min_open_interest_contracts: float = 0.0
    max_snapshot_age_hours: float = 6.0
    max_cross_source_skew_minutes: float = 30.0


@dataclass(frozen=True)
class NameRules:
    automatic_fuzzy_match: bool = True
    minimum_score: float = 96.0
    minimum_runner_up_gap: float = 4.0
    # Candidates below this similarity are not offered for review.
    review_floor: float = 90.0


@dataclass(frozen=True)
class MeanRules:
    """Current-quote estimation: eligibility, dispersion update, and residual limits."""

    mean_bounds: Mapping[str, tuple[float, float]] = field(default_factory=lambda: {
        "passing_yards": (0.01, 10000.0), "passing_touchdowns": (0.01, 100.0),
        "rushing_yards": (0.01, 5000.0), "rushing_touchdowns": (0.01, 50.0),
        "receiving_yards": (0.01, 5000.0), "receiving_touchdowns": (0.01, 50.0),
        "receptions": (0.01, 300.0),
    })
    dispersion_bounds: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {stat: (0.05, 1000.0) for stat in TARGET_STATS})
    probability_floor: float = 0.02
    probability_ceiling: float = 0.98
    minimum_calibration_groups: int = 4
    minimum_thresholds_per_group: int = 2
    dispersion_mode: str = "historical_with_current_market_update"
    max_current_market_logit_rmse: float = 0.35
    max_current_market_holdout_logit_mae: float = 0.60
    max_current_market_log_dispersion_delta: float = 0.50
    current_market_conflict_policy: str = "warning"
    max_sportsbook_probability_residual: float = 1e-8
    max_curve_logit_rmse: float = 0.35
    max_curve_holdout_logit_mae: float = 0.60
    near_even_probability_band: tuple[float, float] = (0.45, 0.55)
    max_near_even_mean_shift_relative: float = 0.10
    max_near_even_mean_shift_absolute: float = 2.0
    confidence_level: float = 0.90
    market_update_version: str = "negative_binomial_current_market_v3"
    source_estimation_version: str = "negative_binomial_source_means_v3"
    # Curves with more quotes than this are fitted by distributed rounds.
    max_curve_quotes_per_task: int = 2048


@dataclass(frozen=True)
class AggregationRules:
    minimum_sources: int = 1
    renormalize_available_source_weights: bool = True
    max_absolute_disagreement: float = 100.0
    max_relative_disagreement: float = 0.20


@dataclass(frozen=True)
class ScoringRules:
    missing_stat_policy: str = "blank_total"
    weights: Mapping[str, float] = field(default_factory=lambda: {
        "passing_yards": 0.04, "passing_touchdowns": 4.0, "passing_interceptions": -2.0,
        "rushing_yards": 0.10, "rushing_touchdowns": 6.0, "receiving_yards": 0.10,
        "receiving_touchdowns": 6.0, "fumbles_lost": -2.0, "two_point_conversions": 2.0,
    })
    bonus_component: str = "receptions"
    bonuses: Mapping[str, float] = field(default_factory=lambda: {
        "standard": 0.0, "half_ppr": 0.5, "three_quarter_ppr": 0.75, "full_ppr": 1.0,
    })
    required_profiles: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {
        "passing": ("passing_yards", "passing_touchdowns"),
        "rushing": ("rushing_yards", "rushing_touchdowns"),
        "receiving": ("receiving_yards", "receiving_touchdowns", "receptions"),
    })

    @property
    def components(self) -> tuple[str, ...]:
        return (*self.weights, self.bonus_component)
