"""The pipeline, planned for large logs.

Run operator by operator, the point and station figures would each send all sessions through a join.
Here every figure comes from one aggregate per (point, station), whole points are dropped at the
(point, day) grain, and the sessions themselves are shuffled three times: to drop copies, to look at
the next session, and, after partial sums, to (point, day). What follows is bounded by the calendar.

    sessions -> day_table -> point_features -> station_rollup -> preprocess -> interactions
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.functions.durable import durable
from plugtide.functions.lookups import attach
from plugtide.functions.times import micros_between
from plugtide.operators import enrich, expand, filters, grid, overlaps, prepare, repair, rolling, rollup
from plugtide.plans import calendar
from plugtide.sources import tables

Step = Callable[..., DataFrame] | tuple[Callable[..., DataFrame], dict]


def compose(df: DataFrame, steps: Iterable[Step], cut: bool = False) -> DataFrame:
    """Applies steps in order; a step is a function of the table, or a pair with its arguments.

    With `cut` the table is written after each step, so that steps that read it twice do not
    multiply the work of all steps before them.
    """
    for step in steps:
        function, arguments = step if isinstance(step, tuple) else (step, {})
        df = function(df, **arguments)
        if cut:
            df = durable(df, function.__name__)
    return df


def cleaning_steps(points: DataFrame, settings: Settings) -> list[Step]:
    """The cleaning operators one by one; `clean` gives the same rows in one pass."""
    s = {"settings": settings}
    return [
        (enrich.merge_type, {"points": points}),
        repair.drop_copies, repair.fix_end_before_start, repair.infer_stop, repair.fill_energy_end,
        repair.correct_duration, (filters.drop_old, s), (filters.desired_range, s),
        (filters.drop_short, s), filters.drop_no_energy, (filters.drop_long, s),
        (filters.active_life_filter, s), (filters.charger_type, s), (filters.min_sessions, s),
        overlaps.fix_overlaps,
    ]


def feature_steps(holidays: DataFrame, population: DataFrame, settings: Settings) -> list[Step]:
    """The session-level feature operators one by one, up to average busyness."""
    return [
        enrich.energy_kwh, enrich.charging_time, enrich.station_avg_power, enrich.point_avg_power,
        enrich.station_points, (enrich.time_features, {"date_col": "started_at"}), enrich.session_dates,
        (enrich.holiday_flag, {"holidays": holidays, "radius_days": settings.holiday_radius_days}),
        (enrich.population_join, {"population": population}), enrich.city_type,
        expand.split_days, expand.period_allocation, expand.average_busyness,
    ]


def grid_steps(holidays: DataFrame, settings: Settings) -> list[Step]:
    """From session-day-period rows to the complete grid, operator by operator."""
    s = {"settings": settings}
    return [
        grid.aggregate_by_point, grid.operation_time, (grid.period_busyness, s),
        (grid.fill_grid, {"holidays": holidays, **s}), grid.operation_time,
    ]


def rolling_steps(settings: Settings) -> list[Step]:
    return [
        rolling.rolling_daily, rolling.rolling_period, (rolling.rolling_iqr, {"settings": settings}),
        rolling.past_week, rolling.cumulative_daily, rolling.cumulative_period,
    ]


# --- one pass over the sessions ------------------------------------------------------------------

def repaired(sessions: DataFrame, settings: Settings) -> DataFrame:
    """Copies dropped, rows repaired, old sessions dropped."""
    return compose(sessions, [
        repair.drop_copies, repair.fix_end_before_start, repair.infer_stop, repair.fill_energy_end,
        repair.correct_duration, (filters.drop_old, {"settings": settings}),
    ])


def written_log(sessions: DataFrame, settings: Settings) -> DataFrame:
    """The repaired log as a table, each file in time order, so that a range skips most row groups."""
    return durable(repaired(sessions, settings).sortWithinPartitions("started_at"), "repaired")


def usable(settings: Settings) -> Column:
    """The row filters that follow the point's first and final day."""
    return (
        filters.in_range(settings)
        & filters.keep_unless(filters.too_short(settings))
        & filters.keep_unless(filters.without_energy())
        & filters.keep_unless(filters.too_long(settings))
    )


def point_stations(rows: DataFrame, settings: Settings) -> DataFrame:
    """One row per (point, station) with everything that points and stations are judged by."""
    ok = usable(settings)
    charging = micros_between(F.col("started_at"), F.col("last_energy_change_at"))
    return rows.groupBy("evse_uid", "location_name").agg(
        *filters.active_days(settings),
        F.count(F.when(ok, F.col("started_at"))).alias("_sessions"),
        F.sum(F.when(ok, F.col("duration_seconds"))).alias("_used"),
        F.min(F.when(ok, F.col("started_at"))).alias("_ok_first"),
        F.max(F.when(ok, F.col("stopped_at"))).alias("_ok_last"),
        F.sum(F.when(ok, F.col("energy_wh") / 1000)).alias("_kwh"),
        F.sum(F.when(ok, charging)).alias("_charging"),
    )


def _power(name: str) -> Column:
    kwh = F.coalesce(F.sum("_kwh"), F.lit(0.0))
    return enrich.average_kw(kwh, F.coalesce(F.sum("_charging"), F.lit(0)) / F.lit(1e6)).alias(name)


def kept_points(pairs: DataFrame, points: DataFrame, settings: Settings) -> DataFrame:
    """The points that pass the point filters, with their type, days and power."""
    used = filters.used_share(F.col("_used"), F.col("_ok_first"), F.col("_ok_last"))
    return (
        pairs.filter(F.col("evse_uid").isNotNull())
        .groupBy("evse_uid")
        .agg(
            F.min("_first").alias("_first"),
            F.max("_final").alias("_final"),
            F.max("_last_pre").alias("_last_pre"),
            F.sum("_sessions").alias("_sessions"),
            F.sum("_used").alias("_used"),
            F.min("_ok_first").alias("_ok_first"),
            F.max("_ok_last").alias("_ok_last"),
            _power("point_avg_power"),
        )
        .filter(filters.keep_unless(used < settings.active_life))
        .filter(F.col("_sessions") >= F.greatest(F.lit(settings.min_sessions), F.lit(1)))
        .join(enrich.types_by_point(points), "evse_uid", "left")
        .filter(F.col("type") == settings.point_type)
        .select("evse_uid", "type", "point_avg_power", "_sessions", *filters.active_day_columns())
    )


def kept_stations(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Power and number of points per station, over the kept points."""
    return (
        pairs.filter((F.col("_sessions") > 0) & F.col("location_name").isNotNull())
        .join(points.select("evse_uid"), "evse_uid", "left_semi")
        .groupBy("location_name")
        .agg(_power("station_avg_power"), F.count("evse_uid").alias("station_charging_points"))
    )


def clean(sessions: DataFrame, points: DataFrame, settings: Settings) -> DataFrame:
    """The cleaned sessions, as the cleaning operators leave them one after the other."""
    rows = written_log(sessions, settings)
    kept = kept_points(point_stations(rows, settings), points, settings).drop("point_avg_power")
    cleaned = attach(rows.filter(usable(settings)), kept, ["evse_uid"], rows_per_key="_sessions")
    return overlaps.fix_overlaps(cleaned.filter(F.col("type").isNotNull()))


def period_columns() -> dict[str, Column]:
    last = config.PERIOD_NAMES[-1]
    return {
        name: expand.period_usage(F.lit(start).cast("bigint"), F.lit(end).cast("bigint"), F.lit(name == last))
        for name, start, end, _ in config.DAY_PERIODS
    }


def use_by_day(rows: DataFrame, settings: Settings) -> DataFrame:
    """One row per (point, day): seconds of use per period, first and last moment, and place.

    Periods are columns here, so a session day is one row in the shuffle and not five.
    """
    needed = ["evse_uid", "started_at", "stopped_at", "last_energy_change_at", "energy_wh"]
    place = ["location_name", "location_city", "country"]
    sessions = overlaps.fix_overlaps(rows.filter(usable(settings)).select(*needed, *place))
    known = sessions.filter(F.col("location_city").isNotNull() & F.col("country").isNotNull())
    days = expand.split_days(enrich.session_dates(known.drop("energy_wh", "last_energy_change_at")))
    return (
        days.withColumns(period_columns())
        .groupBy("evse_uid", "session_date")
        .agg(
            *[F.coalesce(F.sum(p), F.lit(0.0)).alias(p) for p in config.PERIOD_NAMES],
            F.min("started_at").alias("_opened"),
            F.max("stopped_at").alias("_closed"),
            *[grid.first_known(c) for c in place],
        )
    )


def day_table(
    sessions: DataFrame, points: DataFrame, population: DataFrame, settings: Settings
) -> DataFrame:
    """Use per (kept point, day) with the attributes of point, station and city.

    The repaired log is written, since it is read for the points and again for the days; both
    readings prune its columns and push the range into the scan.
    """
    rows = written_log(sessions, settings)
    pairs = durable(point_stations(rows, settings), "point-stations")
    kept = durable(kept_points(pairs, points, settings), "points")
    # Points that are dropped leave before their sessions are shuffled.
    of_kept = rows.join(kept.select("evse_uid"), "evse_uid", "left_semi")
    days = use_by_day(of_kept, settings).join(kept.drop("_sessions"), "evse_uid")
    days = attach(days, kept_stations(pairs, kept), ["location_name"])
    return enrich.city_type(enrich.population_join(days, population)).drop("population")


def grid_from_days(days: DataFrame, holidays: DataFrame, settings: Settings) -> DataFrame:
    """The complete grid from the day table; equal to the grid of the single operators."""
    return calendar.to_periods(calendar.filled_days(days, holidays, settings), calendar.GRID_FIELDS)


def point_features(
    sessions: DataFrame,
    points: DataFrame,
    holidays: DataFrame,
    population: DataFrame,
    settings: Settings,
) -> DataFrame:
    """The point-level feature table: the whole first half of the pipeline."""
    days = durable(day_table(sessions, points, population, settings), "days")
    filled = durable(calendar.filled_days(days, holidays, settings), "filled-days")
    return calendar.to_periods(calendar.rolled_days(filled, settings), calendar.FEATURE_FIELDS)


def refreshed_features(
    path: str,
    sessions: DataFrame,
    points: DataFrame,
    holidays: DataFrame,
    population: DataFrame,
    settings: Settings,
    buckets: int = 64,
) -> DataFrame:
    """The point-level feature table kept at `path`, where only what has changed is worked out again.

    The day table is made anew: it is the cheap half, and holds all that one point's features take from
    other points (the figures of its station). Points are dealt to `buckets`; the grid and the
    rolling part run for the buckets with a changed day row. Other settings, holidays or another first
    day of the data change every bucket. Under `compat` a group's first day looks into the group
    before it, so any change there changes all.
    """
    spark = sessions.sparkSession
    bucket = F.pmod(F.xxhash64("evse_uid"), F.lit(buckets)).cast("int").alias("bucket")
    days = durable(day_table(sessions, points, population, settings).select("*", bucket), "days")
    start = calendar.first_day(days, settings).first()["first_day"]
    marks = tables.bucket_marks(days, "bucket")
    whole = [tables.settings_mark(settings), tables.table_mark(holidays), str(start), str(buckets)]
    if settings.compat:
        whole.append(str(sorted(marks.items())))

    def compute(changed: list[int]) -> DataFrame:
        own = days.filter(F.col("bucket").isin(changed)).drop("bucket") if changed else days.limit(0).drop("bucket")
        filled = durable(calendar.filled_days(own, holidays, settings, F.lit(start)), "filled-days")
        features = calendar.to_periods(calendar.rolled_days(filled, settings), calendar.FEATURE_FIELDS)
        return features.select("*", bucket)

    return tables.refresh(spark, path, "|".join(whole), marks, compute)


# --- from the feature table to train and test ----------------------------------------------------

def at_grain(features: DataFrame, settings: Settings) -> DataFrame:
    return rollup.station_rollup(features, settings) if settings.grain == "stations" else features


def split(df: DataFrame, settings: Settings) -> DataFrame:
    """The table split in time order, written: encodings and shifts read it again."""
    return durable(prepare.sequential_split(df, settings.group, settings.split_ratio), "split")


def preprocess(df: DataFrame, settings: Settings) -> DataFrame:
    """Target encoding and ordinal encoding of a split table."""
    df = prepare.target_encode(
        df, ["location_city", settings.group], "daily_period_busyness", settings.alpha
    )
    return prepare.ordinal_encode(df)


def model_columns(settings: Settings) -> set[str]:
    """The columns of the feature table that the training matrix is made from."""
    pairs = [*config.PRODUCTS.values(), *config.DIFFERENCES.values()]
    made = {f"{c}_encoded" for c in (*config.ORDINAL_ORDERS, "location_city", settings.group)}
    made |= {*config.SHIFTED, *config.PRODUCTS, *config.DIFFERENCES}
    read = {*settings.features, *config.ORDINAL_ORDERS, *config.SHIFTED.values(), *(c for pair in pairs for c in pair)}
    order = {"session_date", "day_period", "evse_uid", "location_name", "location_city"}
    return order | {"daily_period_busyness", "daily_period_busyness_cat"} | (read - made)


def model_table(features: DataFrame, settings: Settings) -> DataFrame:
    """The training matrix from the feature table; what it does not take is not worked out.

    `features` is read twice, the first time for the few columns that means are taken from. The rows are
    shuffled to their group once: the split and the shifts both run there, and the encodings come last.
    """
    grain, needed = at_grain(features, settings), model_columns(settings)
    parts = prepare.sequential_split(
        grain.select(*[c for c in grain.columns if c in needed]), settings.group, settings.split_ratio
    )
    targets, averaged = ["location_city", settings.group], prepare.averaged_sources(config.SHIFTED)
    means = durable(parts.select("is_train", *dict.fromkeys([*targets, "daily_period_busyness", *averaged])), "means-from")
    df = prepare.interactions(prepare.ordinal_encode(parts), settings.group, means_from=means)
    df = prepare.target_encode(
        prepare.label_encode(df), targets, "daily_period_busyness", settings.alpha, means_from=means
    )
    return prepare.training_matrix(df, settings)
