"""Settings and the fixed values of the domain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: names, orders and bounds that results depend on -----------------------------

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]
MONTH_TO_SEASON = {
    "December": "Winter", "January": "Winter", "February": "Winter",
    "March": "Spring", "April": "Spring", "May": "Spring",
    "June": "Summer", "July": "Summer", "August": "Summer",
    "September": "Autumn", "October": "Autumn", "November": "Autumn",
}

# day period, first second of the day, last second of the day, length in seconds; the last period
# ends at 23:59:59 and its length counts the second before midnight too.
DAY_PERIODS = [
    ("early_morning", 0, 21600, 21600),
    ("morning", 21600, 43200, 21600),
    ("afternoon", 43200, 61200, 18000),
    ("evening", 61200, 75600, 14400),
    ("night", 75600, 86399, 10800),
]
PERIOD_NAMES = [p[0] for p in DAY_PERIODS]
LAST_SECOND = 86399
DAY_SECONDS = 86400

# Left-closed bins: (lower bound, label); the upper bound is the next lower bound.
CITY_BINS = [(0, "Village"), (1e4, "Town"), (1e5, "City"), (1e6, "Metropolis")]
CITY_TYPES = [label for _, label in CITY_BINS]
UNKNOWN_POPULATION = 1000
BUSYNESS_BINS = [(0, "Not Busy"), (0.10, "Busy")]
BUSYNESS_UPPER = 1.01
BUSYNESS_ORDER = [label for _, label in BUSYNESS_BINS]
POSITIVE_LABEL = "Busy"

ORDINAL_ORDERS = {
    "season": SEASONS,
    "weekday": WEEKDAYS,
    "month": MONTHS,
    "city_type": CITY_TYPES,
    "day_period": PERIOD_NAMES,
}

# new column -> source column
SHIFTED = {
    "holiday_1d_shift": "holiday_period",
    "weekday_enc_1d_shift": "weekday_encoded",
    "daily_busyness_2d_shift": "daily_rolling_avg_1d",
    "daily_period_busyness_2d_shift": "daily_period_rolling_avg_1d",
}
PRODUCTS = {
    "weekday_x_holiday": ("weekday_encoded", "holiday_period"),
    "weekday_x_day_period": ("weekday_encoded", "day_period_encoded"),
    "weekday_x_holiday_1d_shift": ("weekday_enc_1d_shift", "holiday_1d_shift"),
}
DIFFERENCES = {
    "busyness_change": ("daily_rolling_avg_1d", "daily_busyness_2d_shift"),
    "period_busyness_change": ("daily_period_rolling_avg_1d", "daily_period_busyness_2d_shift"),
}

STATION_FEATURES = [
    "day_period_encoded", "month_encoded", "season_encoded", "weekday_encoded", "holiday_period",
    "station_avg_power", "station_charging_points", "city_type_encoded",
    "daily_rolling_avg_1d", "daily_rolling_avg_7d", "daily_rolling_avg_30d",
    "weekly_cumulative_average", "daily_cumulative_average",
    "days_since_data_start", "weeks_since_data_start", "gap_days",
    "daily_period_rolling_avg_1d", "daily_period_rolling_avg_7d", "daily_period_rolling_avg_30d",
    "past_week_same_period", "daily_period_rolling_IQR_7d", "daily_period_rolling_IQR_30d",
    "period_daily_cumulative_average", "period_weekly_cumulative_average",
    "avg_total_busyness", "avg_day_period_busyness",
    "weekday_x_holiday", "weekday_x_day_period", "weekday_x_holiday_1d_shift",
    "busyness_change", "period_busyness_change", "period_duration",
]
POINT_FEATURES = STATION_FEATURES[:8] + ["point_avg_power"] + STATION_FEATURES[8:]

# Attributes whose first known value stands for a (day, period, point), those that idle days carry
# over, those whose first value stands for a station, and those averaged over its points.
POINT_FIRSTS = [
    "type", "first_active_day", "final_active_day", "last_session_pre_data", "period_duration",
    "month", "country", "weekday", "season", "year", "location_city", "location_name",
    "holiday_period", "city_type", "station_charging_points", "station_avg_power",
    "point_avg_power", "gap_days", "avg_total_busyness", "avg_day_period_busyness",
]
CARRIED = [
    "type", "first_active_day", "final_active_day", "last_session_pre_data", "country",
    "location_city", "location_name", "city_type", "station_charging_points", "station_avg_power",
    "point_avg_power", "avg_total_busyness", "period_duration",
]
STATION_FIRSTS = [
    "month", "country", "weekday", "season", "year", "location_city", "holiday_period", "city_type",
    "station_charging_points", "station_avg_power", "period_duration",
    "days_since_data_start", "weeks_since_data_start",
]
STATION_MEANS = [
    "avg_total_busyness", "avg_day_period_busyness", "daily_period_busyness", "daily_busyness",
    "daily_rolling_avg_1d", "daily_rolling_avg_7d", "daily_rolling_avg_30d",
    "daily_period_rolling_avg_1d", "daily_period_rolling_avg_7d", "daily_period_rolling_avg_30d",
    "daily_period_rolling_IQR_7d", "daily_period_rolling_IQR_30d", "past_week_same_period",
    "daily_cumulative_average", "weekly_cumulative_average",
    "period_daily_cumulative_average", "period_weekly_cumulative_average",
]

# Ranges of the hyper-parameter search: whole numbers include both ends.
FOREST_SPACE = {
    "trees": (100, 2500),
    "min_leaf": (1, 19),
    "depth": (10, 20),
    "feature_subset": ["sqrt", "log2", "all"],
    "impurity": ["gini", "entropy"],
    "min_split": (2, 19),
}
DEEP_BOOST_SPACE = {
    "trees": (100, 2500),
    "learning_rate": (0.01, 0.31),
    "depth": (3, 19),
    "row_share": (0.7, 1.0),
    "feature_share": (0.6, 1.0),
    "min_gain": (0.0, 0.5),
    "l2": (1.0, 3.0),
    "l1": (0.0, 1.0),
}
LEAF_BOOST_SPACE = {
    "trees": (100, 2500),
    "learning_rate": (0.01, 0.31),
    "depth": (3, 19),
    "min_leaf": (20, 99),
    "row_share": (0.7, 1.0),
    "feature_share": (0.6, 1.0),
    "leaves": (20, 59),
}
SEARCH_SPACES = {"forest": FOREST_SPACE, "boosted_deep": DEEP_BOOST_SPACE, "boosted_leaf": LEAF_BOOST_SPACE}


@dataclass(frozen=True)
class Settings:
    """Every knob of the pipeline.

    `search_spaces` holds the ranges that the random search draws from, per model.

    `compat` keeps four quirks of the established results: the open upper busyness bin, grids that
    run past the range, the carried period length, and the spread measure that looks into the
    preceding group on a group's first day. Switch it off for the repaired rules.
    """

    oldest_year: int = 2021
    min_session_s: int = 30
    max_session_s: int = 172800
    active_life: float = 0.05
    min_sessions: int = 30
    holiday_radius_days: int = 2
    point_type: str = "public"
    remove_before: str = "2022-01-01"
    remove_after: str = "2023-01-01"
    grain: str = "stations"
    alpha: float = 10.0
    seed: int = 42
    split_ratio: float = 0.8
    folds: int = 3
    search_iterations: int = 150
    search_spaces: Mapping[str, Mapping] = field(default_factory=lambda: SEARCH_SPACES)
    fit_parallelism: int = 2
    importance_share: float = 0.90
    max_features: int = 10
    tune_on: str = "test"
    compat: bool = True

    @property
    def group(self) -> str:
        """The column that names the thing whose busyness is predicted."""
        return {"points": "evse_uid", "stations": "location_name"}[self.grain]

    @property
    def features(self) -> list[str]:
        return {"points": POINT_FEATURES, "stations": STATION_FEATURES}[self.grain]
