"""Point x day x period: the aggregate, the complete calendar grid and what is filled in on it.

From here on one point has at most five rows per calendar day, so windows per point are bounded by
the calendar and need no splitting. Everything is partitioned by point once and stays there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.functions.bins import left_closed
from plugtide.functions.times import midnight
from plugtide.operators.enrich import holiday_flag, time_features
from plugtide.operators.expand import period_length
from plugtide.schema import require

KEYS = ["session_date", "day_period", "evse_uid"]


def first_known(name: str, order: str = "started_at") -> Column:
    """The first value that is not NULL, by `order`; ties go to the least value."""
    value = F.col(name)
    return F.min_by(value, F.when(value.isNotNull(), F.struct(order, name))).alias(name)


def aggregate_by_point(df: DataFrame) -> DataFrame:
    """One row per (day, period, point): summed use and the first known value of the attributes."""
    require(df, *KEYS, "usage_time", "started_at")
    return df.groupBy(*KEYS).agg(
        F.coalesce(F.sum("usage_time"), F.lit(0.0)).alias("usage_time"),
        *[first_known(c) for c in config.POINT_FIRSTS if c in df.columns],
    )


def operation_time(df: DataFrame, data_start: Column | None = None) -> DataFrame:
    """Days and full weeks since the first day of the data, and since the point's own first day.

    `data_start` saves the pass for the table's first day where the caller knows it already.
    """
    if data_start is None:
        data_start = df.agg(F.min("session_date")).scalar()
    days = F.datediff("session_date", data_start)
    own = F.datediff("session_date", "first_active_day")
    return df.withColumns({
        "days_since_data_start": days,
        "weeks_since_data_start": F.floor(days / 7).cast("int"),
        "days_since_point_active": own,
        "weeks_since_point_active": F.floor(own / 7).cast("int"),
    })


def busyness_category(busyness: Column, settings: Settings) -> Column:
    upper = config.BUSYNESS_UPPER if settings.compat else None
    return left_closed(busyness, config.BUSYNESS_BINS, upper)


def period_busyness(df: DataFrame, settings: Settings) -> DataFrame:
    """Use over the length of the period, and its category."""
    busyness = F.col("usage_time") / period_length(F.col("day_period"))
    return df.withColumns({
        "daily_period_busyness": busyness,
        "daily_period_busyness_cat": busyness_category(busyness, settings),
    })


def day_spans(days: DataFrame, settings: Settings) -> DataFrame:
    """Adds, to one row per (point, day), the days each row stands for: `_since` to `_until`.

    A row covers itself and the idle days up to the point's next row; the first one also reaches
    back to the start of the point's range and the last one on to its end.
    """
    point = Window.partitionBy("evse_uid")
    by_day = point.orderBy("session_date")
    before = F.lit(settings.remove_before).cast("date")
    last_in_range = F.date_sub(F.lit(settings.remove_after).cast("date"), 1)

    opened = F.greatest(F.min("first_active_day").over(point), before)
    closed = F.max("final_active_day").over(point)
    if not settings.compat:
        closed = F.least(closed, last_in_range)

    own = F.col("session_date")
    is_first = F.lag("session_date").over(by_day).isNull()
    following = F.lead("session_date").over(by_day)
    return days.withColumns({
        "_since": F.when(is_first, F.least(own, opened)).otherwise(own),
        "_until": F.coalesce(F.date_sub(following, 1), F.greatest(own, closed)),
    })


def gap_fill(spans: DataFrame) -> DataFrame:
    """One row per day of every span; `_real` tells the rows that were there.

    The calendar needs no join: a look ahead, a sequence of dates, an explode.
    """
    dates = F.sequence("_since", "_until", F.expr("interval 1 day"))
    return (
        spans.withColumn("_date", F.explode(dates))
        .withColumn("_real", F.col("_date") == F.col("session_date"))
        .withColumns({"session_date": F.col("_date"), "_leading": F.col("_date") < F.col("session_date")})
        .drop("_since", "_until", "_date")
    )


def calendar_grid(df: DataFrame, settings: Settings) -> DataFrame:
    """Every (point, day of its range, period); new rows have NULL in all other columns."""
    values = [c for c in df.columns if c not in KEYS]
    in_period = [
        F.first(F.when(F.col("day_period") == p, F.struct(*values)), ignorenulls=True).alias(f"_{p}")
        for p in config.PERIOD_NAMES
    ]
    # One exchange, on the point: the day rows, the look ahead and all later windows live in it.
    days = (
        df.repartition("evse_uid")
        .groupBy("evse_uid", "session_date")
        .agg(
            F.min("first_active_day").alias("first_active_day"),
            F.max("final_active_day").alias("final_active_day"),
            *in_period,
        )
    )
    periods = F.array(*[
        F.struct(F.lit(p).alias("period"), F.when(F.col("_real"), F.col(f"_{p}")).alias("row"))
        for p in config.PERIOD_NAMES
    ])
    return (
        gap_fill(day_spans(days, settings))
        .select("session_date", "evse_uid", F.explode(periods).alias("_p"))
        .select(
            "session_date",
            F.col("_p.period").alias("day_period"),
            "evse_uid",
            *[F.col(f"_p.row.{c}").alias(c) for c in values],
        )
    )


def carry_attributes(df: DataFrame, settings: Settings) -> DataFrame:
    """Attributes of the point carried forward over the rows of the grid, then backward."""
    rows = Window.partitionBy("evse_uid").orderBy("session_date", "day_period")
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    everywhere = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = {
        # Where nothing came before, the first known value of the point is the next one to come.
        c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.first(c, ignorenulls=True).over(everywhere))
        for c in config.CARRIED
        if c in df.columns
    }
    if not settings.compat and "period_duration" in carried:
        carried["period_duration"] = period_length(F.col("day_period"))
    return df.withColumns(carried)


def gap_days(df: DataFrame) -> DataFrame:
    """Days since the last use, seen from five rows (one day of periods) back in grid order."""
    rows = Window.partitionBy("evse_uid").orderBy("session_date", "day_period")
    a_day_back = rows.rowsBetween(Window.unboundedPreceding, -len(config.DAY_PERIODS))
    used = F.when(F.col("usage_time") > 0, F.col("session_date"))
    last_used = F.coalesce(F.last(used, ignorenulls=True).over(a_day_back), F.col("last_session_pre_data"))
    return df.withColumn("gap_days", F.coalesce(F.datediff("session_date", last_used), F.lit(0)))


def fill_grid(df: DataFrame, holidays: DataFrame, settings: Settings) -> DataFrame:
    """The complete grid with idle rows filled in and calendar columns taken from the grid's dates."""
    grid = carry_attributes(calendar_grid(df, settings), settings)
    return complete_grid(grid, holidays, settings)


def complete_grid(grid: DataFrame, holidays: DataFrame, settings: Settings) -> DataFrame:
    """Constants for idle rows, calendar columns, holidays, gap days and the period average."""
    period_rows = (
        Window.partitionBy("evse_uid", "day_period")
        .orderBy("session_date")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    grid = grid.withColumns({
        "daily_period_busyness": F.coalesce("daily_period_busyness", F.lit(0.0)),
        "daily_period_busyness_cat": F.coalesce("daily_period_busyness_cat", F.lit(config.BUSYNESS_ORDER[0])),
        "usage_time": F.coalesce("usage_time", F.lit(0.0)),
        "started_at": midnight(F.col("session_date")),
    })
    grid = time_features(grid, "session_date")
    grid = holiday_flag(grid, holidays, "session_date", settings.holiday_radius_days)
    return gap_days(grid).withColumn(
        "avg_day_period_busyness", F.first("avg_day_period_busyness", ignorenulls=True).over(period_rows)
    )
