"""Sessions to days, days to day periods, and the busyness a point shows on average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide import config
from plugtide.functions.lookups import attach
from plugtide.functions.times import MICROS, micros_between, midnight, plus_seconds, seconds_between, weekday_name


def split_days(df: DataFrame) -> DataFrame:
    """One row per calendar day of a session.

    A session within one day stays as it is; one whose stop day lies before its start day yields
    nothing. Parts end at 23:59:59, so a part before the last counts one more second. The energy
    follows the seconds until the energy end; after that a part has none.
    """
    span = F.coalesce(F.datediff("end_date", "session_date"), F.lit(0))
    df = df.withColumn("_span", span).filter(F.col("_span") >= 0)
    df = df.withColumn("_n", F.explode(F.sequence(F.lit(0), F.col("_span"))))

    split = F.col("_span") > 0
    first, final = F.col("_n") == 0, F.col("_n") == F.col("_span")
    date = F.date_add("session_date", F.col("_n"))
    df = df.withColumns({
        "_date": date,
        "_from": F.when(first, F.col("started_at")).otherwise(midnight(date)),
        "_to": F.when(final, F.col("stopped_at")).otherwise(
            plus_seconds(midnight(date), F.lit(config.LAST_SECOND))
        ),
    })

    lec = F.col("last_energy_change_at")
    days_left = F.datediff(F.to_date(lec), F.col("_date"))
    part_s = seconds_between(F.col("_from"), F.col("_to"))
    charging_s = (
        F.when(days_left > 0, part_s + 1)
        .when(days_left == 0, seconds_between(F.col("_from"), lec))
        .otherwise(F.lit(0.0))
    )
    charges = F.coalesce(days_left >= 0, F.lit(False))
    energy = F.when(
        charges, F.try_divide(F.col("energy_wh") * charging_s, F.col("session_charging_duration"))
    ).otherwise(F.lit(0.0))
    changed = {
        "started_at": F.col("_from"),
        "stopped_at": F.col("_to"),
        "last_energy_change_at": F.when(days_left > 0, F.col("_to")).when(days_left == 0, lec),
        "energy_wh": energy,
        "energy_kwh": energy / 1000,
        "session_charging_duration": charging_s,
        "session_date": F.col("_date"),
        "end_date": F.col("_date"),
        "weekday": weekday_name(F.col("_date")),
    }
    changed = {name: new for name, new in changed.items() if name in df.columns}
    kept = [c for c in df.columns if not c.startswith("_")]
    return df.select(
        *[
            F.when(split, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in kept
        ],
        F.when(split, (part_s + F.when(final, 0).otherwise(1)).cast("bigint")).alias("session_duration"),
    )


def period_usage(start_s: Column, end_s: Column, last_period: Column) -> Column:
    """Seconds of a row's session inside the period [start_s, end_s] of its start day.

    NULL when a bound of the session is NULL. The last period gets the second before midnight back
    whenever the session stops at exactly 23:59:59.
    """
    day = midnight(F.to_date("started_at"))
    opened = micros_between(day, F.col("started_at"))
    closed = micros_between(day, F.col("stopped_at"))
    overlap = F.least(closed, end_s * MICROS) - F.greatest(opened, start_s * MICROS)
    overlap = F.when(opened.isNotNull() & closed.isNotNull(), F.greatest(overlap, F.lit(0)))

    stop_of_day = micros_between(midnight(F.to_date("stopped_at")), F.col("stopped_at"))
    at_last_second = last_period & (stop_of_day == config.LAST_SECOND * MICROS)
    return (overlap + F.when(at_last_second, F.lit(MICROS)).otherwise(F.lit(0))) / F.lit(float(MICROS))


def period_allocation(df: DataFrame) -> DataFrame:
    """Every row once per day period, with the seconds of use inside it."""
    periods = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.lit(start).cast("bigint").alias("start_s"),
            F.lit(end).cast("bigint").alias("end_s"),
            F.lit(length).cast("bigint").alias("length"),
        )
        for name, start, end, length in config.DAY_PERIODS
    ])
    last = F.col("_p.name") == config.PERIOD_NAMES[-1]
    return df.withColumn("_p", F.explode(periods)).select(
        *df.columns,
        F.col("_p.name").alias("day_period"),
        F.col("_p.length").alias("period_duration"),
        period_usage(F.col("_p.start_s"), F.col("_p.end_s"), last).alias("usage_time"),
    )


def total_share(used_s: Column, lifetime_s: Column) -> Column:
    return F.try_divide(used_s, lifetime_s)


def period_share(used_s: Column, lifetime_s: Column, length: Column) -> Column:
    """Use of one day period over that period's share of the lifetime."""
    return F.try_divide(used_s, lifetime_s * (length / F.lit(config.DAY_SECONDS)))


def period_length(period: Column) -> Column:
    case = F
    for name, _, _, length in config.DAY_PERIODS:
        case = case.when(period == name, F.lit(length).cast("bigint"))
    return case


def average_busyness(df: DataFrame) -> DataFrame:
    """Share of a point's lifetime in use, overall and per day period, on every row."""
    by_period = df.groupBy("evse_uid", "day_period").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.coalesce(F.sum("usage_time"), F.lit(0.0)).alias("_used"),
        F.min("started_at").alias("_first"),
        F.max("stopped_at").alias("_last"),
    )
    by_point = by_period.groupBy("evse_uid").agg(
        F.sum("_used").alias("_used_all"),
        seconds_between(F.min("_first"), F.max("_last")).alias("_lifetime"),
    )
    shares = by_period.join(by_point, "evse_uid").select(
        "evse_uid",
        "day_period",
        "_rows",
        total_share(F.col("_used_all"), F.col("_lifetime")).alias("avg_total_busyness"),
        period_share(F.col("_used"), F.col("_lifetime"), period_length(F.col("day_period"))).alias(
            "avg_day_period_busyness"
        ),
    )
    return attach(df, shares, ["evse_uid", "day_period"], rows_per_key="_rows")
