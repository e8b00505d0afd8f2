"""Presets and fixed values.

Everything that must equal the surveyed system's values for equal results is
stated here once, as plain text, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (weather preset) — must match the surveyed pipeline exactly.
# ---------------------------------------------------------------------------
HOURLY_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "windspeed_10m",
    "surface_pressure",
    "cloudcover",
    "shortwave_radiation",
    "visibility",
]
WEATHER_FEATURES = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "windspeed_10m",
    "surface_pressure",
    "cloudcover",
    "shortwave_radiation",
]
LAG_FEATURES = ["temperature_2m", "relative_humidity_2m", "precipitation", "windspeed_10m"]
LAG_HOURS = [24, 48, 72]
ROLLING_WINDOWS = {"24h": 24, "7d": 168}
RAIN_THRESHOLD_MM = 1.0
HEATWAVE_GLOBAL_THRESHOLD = 35.0
HEATWAVE_SOUTH_ASIA_THRESHOLD = 40.0
STORM_WIND_THRESHOLD = 40.0
STORM_CLOUD_THRESHOLD = 70.0
SOUTH_ASIA_CITIES = ["Karachi", "Delhi", "Mumbai", "Dhaka"]
TRAIN_YEARS = (2009, 2017)
VAL_YEAR = 2018
TEST_YEARS = (2019, 2020)
EXPECTED_YEARS = 15
DAYS_PER_YEAR = 365.25
IQR_K = 1.5
CLASS_NAMES = ["Normal", "Heatwave", "Heavy Rain", "Storm"]
SEASON_NAMES = ["Winter", "Spring", "Summer", "Autumn"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
TIME_FEATURES = ["hour", "day", "month", "year", "season", "is_weekend", "day_of_week", "day_of_year"]
GEO_FEATURES = ["latitude", "longitude", "coastal", "city_id", "continent_id", "climate_zone_id"]
LAG_MARKERS = ["lag_24", "lag_48", "lag_72"]
FEATURE_EXCLUDE = [
    "datetime", "city", "country", "continent", "climate_zone",
    "heatwave_threshold",
    "target_rain", "target_heatwave", "target_storm", "target_disaster",
    "target_temperature_next",
]
EPS_ENTROPY = 1e-10
EPS_MINMAX = 1e-10
FALLBACK_INTERVAL = 2.0
INTERVAL_TARGET_COVERAGE = 0.80
# boosting grids: rounds, depth, learning rate, row share, column share, least child weight (C and D: least gain)
GRID_TEMPERATURE = [
    (400, 6, 0.05, 0.9, 0.9, 3),
    (600, 6, 0.05, 0.9, 0.9, 3),
    (800, 7, 0.05, 0.85, 0.85, 3),
    (1000, 7, 0.03, 0.85, 0.85, 5),
    (1200, 8, 0.03, 0.8, 0.8, 5),
    (1500, 8, 0.02, 0.8, 0.8, 5),
]
GRID_CLASSES = [
    (400, 5, 0.05, 0.9, 0.9, 3, 0.0),
    (600, 6, 0.05, 0.85, 0.85, 3, 0.1),
    (800, 6, 0.03, 0.85, 0.85, 5, 0.1),
    (1000, 7, 0.03, 0.8, 0.8, 5, 0.2),
    (1200, 7, 0.02, 0.8, 0.8, 5, 0.2),
    (1500, 8, 0.02, 0.75, 0.75, 7, 0.3),
]
MIN_GROUP_ROWS = 10
CV_FOLDS = 5
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelSpec:
    """Names the columns of a panel: entity key, order column, tie-break (several columns: one after the other)."""

    entity: str
    order: str
    tiebreak: str | tuple[str, ...] | None = None
    values: tuple[str, ...] = ()

    @property
    def order_cols(self) -> list[str]:
        return [self.order, *([self.tiebreak] if isinstance(self.tiebreak, str) else self.tiebreak or ())]


@dataclass(frozen=True)
class LabelRules:
    """Threshold rules of the rule-based labeller."""

    rain_col: str = "precipitation"
    rain_gt: float = RAIN_THRESHOLD_MM
    heat_col: str = "temperature_2m"
    heat_default: float = HEATWAVE_GLOBAL_THRESHOLD
    heat_special: float = HEATWAVE_SOUTH_ASIA_THRESHOLD
    heat_special_col: str = "city"
    heat_special_members: tuple = tuple(SOUTH_ASIA_CITIES)
    storm_a_col: str = "windspeed_10m"
    storm_a_ge: float = STORM_WIND_THRESHOLD
    storm_b_col: str = "cloudcover"
    storm_b_ge: float = STORM_CLOUD_THRESHOLD


@dataclass(frozen=True)
class FeatureSpec:
    """Lag and rolling configuration of the feature stage."""

    variables: tuple[str, ...] = tuple(LAG_FEATURES)
    lags: tuple[int, ...] = tuple(LAG_HOURS)
    windows: dict = field(default_factory=lambda: dict(ROLLING_WINDOWS))
    lag_suffix: str = "h"

    @property
    def halo(self) -> int:
        return max(list(self.lags) + [w - 1 for w in self.windows.values()] + [0])


WEATHER_PANEL = PanelSpec("city", "datetime", None, tuple(WEATHER_FEATURES))
WEATHER_RULES = LabelRules()
WEATHER_FEATURES_SPEC = FeatureSpec()
