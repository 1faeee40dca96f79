"""Lagged, rolling and cumulative busyness on the grid.

All are windows on (point) or (point, period), so they share the grid's one partitioning by point;
none joins back. Frames hold at most 30 days, or run incrementally from the first day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.functions.ordered import previous_row

FIRST = Window.unboundedPreceding
WINDOWS = (1, 7, 30)
SPREAD_WINDOWS = (7, 30)


def period_rows() -> WindowSpec:
    return Window.partitionBy("evse_uid", "day_period").orderBy("session_date")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def with_spreads(df: DataFrame, spreads: dict[str, tuple[str, WindowSpec]]) -> DataFrame:
    """Adds, per new name, the interquartile range of a column over a frame, linearly interpolated.

    Frames hold at most 30 rows: each is sorted once, as a column of its own, for both quartiles.
    """
    def quartile(name: str, share: float) -> Column:
        values = F.col(f"_sorted_{name}")
        position = (F.size(values) - 1) * F.lit(share)
        low = F.floor(position).cast("int")
        lower, upper = F.get(values, low), F.get(values, F.ceil(position).cast("int"))
        return lower + (upper - lower) * (position - low)

    ordered = {
        f"_sorted_{name}": F.sort_array(F.collect_list(value).over(frame))
        for name, (value, frame) in spreads.items()
    }
    return (
        df.withColumns(ordered)
        .withColumns({name: quartile(name, 0.75) - quartile(name, 0.25) for name in spreads})
        .drop(*ordered)
    )


def _starts(unit: str, group: list[str]) -> Column:
    """True on the first row of each run of `unit` within the group."""
    rows = Window.partitionBy(*group).orderBy("session_date", "day_period")
    return ~F.col(unit).eqNullSafe(F.lag(unit).over(rows))


def rolling_daily(df: DataFrame) -> DataFrame:
    """A point's busyness of the day, and its mean over the 1, 7 and 30 days before."""
    day = Window.partitionBy("evse_uid", "session_date")
    df = df.withColumn("daily_busyness", F.sum("usage_time").over(day) / config.DAY_SECONDS)
    # The day's value on its first row only; averages skip the NULLs on the others.
    df = df.withColumns({
        "_day": F.unix_date("session_date"),
        "_daily": F.when(_starts("session_date", ["evse_uid"]), F.col("daily_busyness")),
    })
    days = Window.partitionBy("evse_uid").orderBy("_day")
    means = {
        f"daily_rolling_avg_{w}d": or_zero(F.avg("_daily").over(days.rangeBetween(-w, -1))) for w in WINDOWS
    }
    return df.withColumns(means).drop("_day", "_daily")


def rolling_period(df: DataFrame) -> DataFrame:
    """Mean busyness of the same period over the 1, 7 and 30 days before."""
    return df.withColumns({
        f"daily_period_rolling_avg_{w}d": or_zero(
            F.avg("daily_period_busyness").over(period_rows().rowsBetween(-w, -1))
        )
        for w in WINDOWS
    })


def rolling_iqr(df: DataFrame, settings: Settings) -> DataFrame:
    """Interquartile range of the period's busyness over the 7 and 30 days before.

    With `compat` the measure is shifted by one row over the whole table in (point, period, day)
    order, so a group's first day shows the group before. Inside a point that is a plain look back;
    a point's very first row takes the last value of the point before, from a table with one row
    per point.
    """
    names = {w: f"daily_period_rolling_IQR_{w}d" for w in SPREAD_WINDOWS}
    if not settings.compat:
        df = with_spreads(df, {
            name: ("daily_period_busyness", period_rows().rowsBetween(-w, -1)) for w, name in names.items()
        })
        return df.withColumns({name: or_zero(F.col(name)) for name in names.values()})

    point_rows = Window.partitionBy("evse_uid").orderBy("day_period", "session_date")
    rows = with_spreads(df, {
        f"_iqr_{w}": ("daily_period_busyness", period_rows().rowsBetween(1 - w, 0)) for w in names
    })
    last = rows.groupBy("evse_uid").agg(*[
        F.max_by(f"_iqr_{w}", F.struct("day_period", "session_date")).alias(f"_last_{w}") for w in names
    ])
    return (
        rows.join(spread_before(last), "evse_uid", "left")
        .withColumns({
            name: or_zero(F.coalesce(F.lag(f"_iqr_{w}").over(point_rows), F.col(f"_before_{w}")))
            for w, name in names.items()
        })
        .drop(*[f"_iqr_{w}" for w in names], *[f"_before_{w}" for w in names])
    )


def spread_before(last: DataFrame) -> DataFrame:
    """Per point, the last spreads (`_last_*`) of the point before it, as `_before_*`."""
    values = {f"_before_{w}": f"_last_{w}" for w in SPREAD_WINDOWS}
    return previous_row(last, ["evse_uid"], values).select("evse_uid", *values)


def past_week(df: DataFrame) -> DataFrame:
    """Busyness of the same period one week before."""
    before = F.lag("daily_period_busyness", 7).over(period_rows())
    return df.withColumn("past_week_same_period", or_zero(before))


def cumulative_daily(df: DataFrame) -> DataFrame:
    """Mean of the daily, and of the weekly, means of a point over all days or weeks before."""
    return _cumulative(
        df, "daily_busyness", ["evse_uid"], "weekly_cumulative_average", "daily_cumulative_average"
    )


def cumulative_period(df: DataFrame) -> DataFrame:
    """The same for each period of the day."""
    return _cumulative(
        df,
        "daily_period_busyness",
        ["evse_uid", "day_period"],
        "period_weekly_cumulative_average",
        "period_daily_cumulative_average",
    )


def _cumulative(df: DataFrame, value: str, group: list[str], weekly: str, daily: str) -> DataFrame:
    for name, unit in ((weekly, "weeks_since_data_start"), (daily, "days_since_data_start")):
        mean = F.avg(value).over(Window.partitionBy(*group, unit))
        earlier = Window.partitionBy(*group).orderBy(unit).rangeBetween(FIRST, -1)
        df = (
            df.withColumns({"_starts": _starts(unit, group), "_mean": mean})
            .withColumn(name, or_zero(F.avg(F.when(F.col("_starts"), F.col("_mean"))).over(earlier)))
            .drop("_starts", "_mean")
        )
    return df
