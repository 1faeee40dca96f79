"""The grid and its rolling features, worked out per (point, day) with one column per period.

The operators in `grid` and `rolling` work on rows of (point, day, period). Here a day is one row
until the very end: a fifth of the rows, and nearly everything is a window on (point) by day, which
Spark evaluates after one exchange and one sort. Results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.functions.times import midnight, seconds_between
from plugtide.operators.enrich import holiday_flag, time_features
from plugtide.operators.expand import period_share, total_share
from plugtide.operators.grid import busyness_category, day_spans, gap_fill, operation_time
from plugtide.operators.rolling import SPREAD_WINDOWS, WINDOWS, or_zero, spread_before, with_spreads

PERIODS = config.PERIOD_NAMES
BY_NAME = sorted(PERIODS)
LENGTHS = {name: length for name, _, _, length in config.DAY_PERIODS}

GRID_FIELDS = [
    "usage_time", "period_duration", "avg_day_period_busyness", "daily_period_busyness",
    "daily_period_busyness_cat", "gap_days",
]
FEATURE_FIELDS = [
    *GRID_FIELDS,
    *[f"daily_period_rolling_avg_{w}d" for w in WINDOWS],
    *[f"daily_period_rolling_IQR_{w}d" for w in SPREAD_WINDOWS],
    "past_week_same_period", "period_daily_cumulative_average", "period_weekly_cumulative_average",
]


def point() -> WindowSpec:
    return Window.partitionBy("evse_uid")


def by_day() -> WindowSpec:
    return point().orderBy("session_date")


def up_to(last: int) -> WindowSpec:
    """All days up to this one (0), up to yesterday (-1), and so on."""
    return by_day().rowsBetween(Window.unboundedPreceding, last)


def all_days() -> WindowSpec:
    return up_to(Window.unboundedFollowing)


def of(period: str, field: str) -> str:
    """The column of a day row that holds a field of one period."""
    return f"{period}__{field}"


def to_periods(days: DataFrame, fields: list[str]) -> DataFrame:
    """Day rows to five rows each."""
    rows = F.array(*[
        F.struct(F.lit(p).alias("day_period"), *[F.col(of(p, f)).alias(f) for f in fields]) for p in PERIODS
    ])
    shared = [c for c in days.columns if "__" not in c and not c.startswith("_")]
    return days.select(*shared, F.inline(rows))


def first_day(days: DataFrame, settings: Settings) -> DataFrame:
    """The first day of any span, in one row, read from the table as it is: a point's first row reaches
    back to its first active day, and that is the same in all its rows."""
    opened = F.greatest("first_active_day", F.lit(settings.remove_before).cast("date"))
    return days.agg(F.min(F.least("session_date", opened)).alias("first_day"))


def filled_days(
    days: DataFrame, holidays: DataFrame, settings: Settings, data_start: Column | None = None
) -> DataFrame:
    """Every day of every point's range, with use, busyness and gap days per period.

    `days` is read more than once and should be a written table. Where it holds only some of the
    points, `data_start` is the `first_day` of all.
    """
    all_use = sum((F.col(p) for p in PERIODS), F.lit(0.0))
    if data_start is None:
        data_start = first_day(days, settings).scalar()
    days = days.withColumns({
        "_lifetime": seconds_between(F.min("_opened").over(point()), F.max("_closed").over(point())),
        "_used": F.sum(all_use).over(point()),
        **{f"_{p}": F.sum(p).over(point()) for p in PERIODS},
        **{
            c: F.coalesce(F.last(c, ignorenulls=True).over(up_to(0)), F.first(c, ignorenulls=True).over(all_days()))
            for c in ("location_name", "station_charging_points", "station_avg_power")
        },
    })
    spans = day_spans(days, settings)

    attributes = [c for c in config.CARRIED if c not in ("period_duration", "avg_total_busyness")]
    busyness = {p: F.col(of(p, "usage_time")) / LENGTHS[p] for p in PERIODS}
    filled = (
        gap_fill(spans)
        .withColumns({of(p, "usage_time"): F.when(F.col("_real"), F.col(p)).otherwise(F.lit(0.0)) for p in PERIODS})
        .select(
            "evse_uid",
            "session_date",
            *attributes,
            total_share(F.col("_used"), F.col("_lifetime")).alias("avg_total_busyness"),
            *[of(p, "usage_time") for p in PERIODS],
            *[busyness[p].alias(of(p, "daily_period_busyness")) for p in PERIODS],
            *[
                F.coalesce(busyness_category(busyness[p], settings), F.lit(config.BUSYNESS_ORDER[0])).alias(
                    of(p, "daily_period_busyness_cat")
                )
                for p in PERIODS
            ],
            *[
                period_share(F.col(f"_{p}"), F.col("_lifetime"), F.lit(LENGTHS[p])).alias(
                    of(p, "avg_day_period_busyness")
                )
                for p in PERIODS
            ],
            *[_period_duration(p, settings).alias(of(p, "period_duration")) for p in PERIODS],
        )
    )
    filled = filled.withColumns(_gap_days()).withColumn("started_at", midnight(F.col("session_date")))
    filled = time_features(operation_time(filled, data_start), "session_date")
    return holiday_flag(filled, holidays, "session_date", settings.holiday_radius_days)


def _period_duration(period: str, settings: Settings) -> Column:
    """With `compat`, idle days carry the length of the row before them in alphabetical period
    order, and leading idle days that of the row after them."""
    own = F.lit(LENGTHS[period])
    if settings.compat:
        own = (
            F.when(F.col("_real"), own)
            .when(F.col("_leading"), F.lit(LENGTHS[BY_NAME[0]]))
            .otherwise(F.lit(LENGTHS[BY_NAME[-1]]))
        )
    return own.cast("bigint")


def _gap_days() -> dict[str, Column]:
    """Five grid rows back from a period means: all days before yesterday, and yesterday up to the
    same period in alphabetical order."""
    in_use = F.greatest(*[of(p, "usage_time") for p in PERIODS]) > 0
    earlier = F.last(F.when(in_use, F.col("session_date")), ignorenulls=True).over(up_to(-2))
    gaps = {}
    for i, period in enumerate(BY_NAME):
        seen = [F.col(of(p, "usage_time")) > 0 for p in BY_NAME[: i + 1]]
        used_yesterday = F.lag(F.array_contains(F.array(*seen), True)).over(by_day())
        last_used = F.when(used_yesterday, F.date_sub("session_date", 1)).otherwise(
            F.coalesce(earlier, F.col("last_session_pre_data"))
        )
        gaps[of(period, "gap_days")] = F.coalesce(F.datediff("session_date", last_used), F.lit(0))
    return gaps


def rolled_days(filled: DataFrame, settings: Settings) -> DataFrame:
    """Adds rolling means, spreads, past week and cumulative means, per day and per period.

    `filled` is read more than once and should be a written table.
    """
    all_use = sum((F.col(of(p, "usage_time")) for p in PERIODS), F.lit(0.0))
    week = "weeks_since_data_start"
    df = filled.withColumns({
        "daily_busyness": all_use / config.DAY_SECONDS,
        "_week_starts": ~F.col(week).eqNullSafe(F.lag(week).over(by_day())),
    })

    measures = {"daily_busyness": ("daily_rolling_avg", "daily_cumulative_average", "weekly_cumulative_average")}
    for p in PERIODS:
        measures[of(p, "daily_period_busyness")] = (
            of(p, "daily_period_rolling_avg"), of(p, "period_daily_cumulative_average"),
            of(p, "period_weekly_cumulative_average"),
        )
    columns, spreads = {}, {}
    for measure, (rolling, daily, _) in measures.items():
        for w in WINDOWS:
            columns[f"{rolling}_{w}d"] = or_zero(F.avg(measure).over(by_day().rowsBetween(-w, -1)))
        columns[daily] = or_zero(F.avg(measure).over(up_to(-1)))
    for p in PERIODS:
        busyness = of(p, "daily_period_busyness")
        columns[of(p, "past_week_same_period")] = or_zero(F.lag(busyness, 7).over(by_day()))
        for w in SPREAD_WINDOWS:
            frame = by_day().rowsBetween(1 - w, 0) if settings.compat else by_day().rowsBetween(-w, -1)
            spreads[of(p, f"_iqr_{w}")] = (busyness, frame)
    df = _shifted_spreads(with_spreads(df.withColumns(columns), spreads), filled, settings)

    # Weekly means sit on the first day of their week; the mean over earlier weeks skips the rest.
    in_week = Window.partitionBy("evse_uid", week)
    weeks_before = point().orderBy(week).rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_mean_{m}": F.avg(m).over(in_week) for m in measures})
    return df.withColumns({
        weekly: or_zero(F.avg(F.when(F.col("_week_starts"), F.col(f"_mean_{m}"))).over(weeks_before))
        for m, (_, _, weekly) in measures.items()
    }).drop(*[f"_mean_{m}" for m in measures])


def _shifted_spreads(df: DataFrame, filled: DataFrame, settings: Settings) -> DataFrame:
    """The spreads of the days before; with `compat`, a group's first day shows the group before."""
    def name(p: str, w: int) -> str:
        return of(p, f"daily_period_rolling_IQR_{w}d")

    own = [(p, w) for p in PERIODS for w in SPREAD_WINDOWS]
    if not settings.compat:
        return df.withColumns({name(p, w): or_zero(F.col(of(p, f"_iqr_{w}"))) for p, w in own})

    previous = dict(zip(BY_NAME[1:], BY_NAME))
    columns = {}
    for p, w in own:
        before = F.col(f"_before_{w}")
        if p in previous:
            before = F.last(of(previous[p], f"_iqr_{w}")).over(all_days())
        columns[name(p, w)] = or_zero(F.coalesce(F.lag(of(p, f"_iqr_{w}")).over(by_day()), before))
    return df.join(spread_before(_last_spreads(filled)), "evse_uid", "left").withColumns(columns)


def _last_spreads(filled: DataFrame) -> DataFrame:
    """The spreads on each point's last day, from its last days alone."""
    last = F.col(of(BY_NAME[-1], "daily_period_busyness"))
    days = (
        filled.select("evse_uid", "session_date", last.alias("_x"))
        .withColumn("_age", F.datediff(F.max("session_date").over(point()), "session_date"))
        .filter(F.col("_age") < max(SPREAD_WINDOWS))
    )

    def spread(w: int) -> Column:
        recent = F.when(F.col("_age") < w, F.col("_x"))
        return F.percentile(recent, 0.75) - F.percentile(recent, 0.25)

    return days.groupBy("evse_uid").agg(*[spread(w).alias(f"_last_{w}") for w in SPREAD_WINDOWS])
