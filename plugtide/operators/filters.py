"""Filters on sessions, and on points by what their sessions add up to.

A filter that removes rows keeps those where its condition is unknown, unless said otherwise.
Per-point figures are aggregated with map-side combine and looked up again; a point with a third of
all sessions never ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide.config import Settings
from plugtide.functions.lookups import attach
from plugtide.functions.times import micros_between


def keep_unless(condition: Column) -> Column:
    return F.coalesce(~condition, F.lit(True))


# --- conditions, shared with the one-pass plan ---------------------------------------------------

def too_old(settings: Settings) -> Column:
    # A plain comparison rather than year(): it can be pushed into a Parquet scan.
    return F.col("started_at") < F.lit(f"{settings.oldest_year}-01-01").cast("timestamp_ntz")


def in_range(settings: Settings) -> Column:
    started = F.col("started_at")
    return (started >= F.lit(settings.remove_before).cast("timestamp_ntz")) & (
        started < F.lit(settings.remove_after).cast("timestamp_ntz")
    )


def too_short(settings: Settings) -> Column:
    return F.col("duration_seconds") < settings.min_session_s


def too_long(settings: Settings) -> Column:
    return F.col("duration_seconds") > settings.max_session_s


def without_energy() -> Column:
    return F.col("energy_wh") <= 0


def before_range(settings: Settings) -> Column:
    return F.col("started_at") < F.lit(settings.remove_before).cast("timestamp_ntz")


def active_days(settings: Settings) -> list[Column]:
    """Aggregates for a point's first and last day and its last session before the range."""
    return [
        F.min("started_at").alias("_first"),
        F.max("started_at").alias("_final"),
        F.max(F.when(before_range(settings), F.col("started_at"))).alias("_last_pre"),
    ]


def active_day_columns() -> list[Column]:
    return [
        F.to_date("_first").alias("first_active_day"),
        F.to_date("_final").alias("final_active_day"),
        F.to_date(F.coalesce("_last_pre", "_first")).alias("last_session_pre_data"),
    ]


def used_share(total_s: Column, first: Column, last: Column) -> Column:
    """Used seconds over the lifetime; NULL for a lifetime of zero."""
    lifetime_s = micros_between(first, last) / F.lit(1e6)
    return F.try_divide(F.coalesce(total_s, F.lit(0.0)), lifetime_s)


# --- operators -----------------------------------------------------------------------------------

def drop_old(df: DataFrame, settings: Settings) -> DataFrame:
    return df.filter(keep_unless(too_old(settings)))


def desired_range(df: DataFrame, settings: Settings) -> DataFrame:
    """Adds a point's first, final and last pre-range day (over all its rows), then cuts the range.

    Rows without a start are dropped here.
    """
    days = (
        df.groupBy("evse_uid")
        .agg(F.count(F.lit(1)).alias("_rows"), *active_days(settings))
        .select("evse_uid", "_rows", *active_day_columns())
    )
    return attach(df.filter(in_range(settings)), days, ["evse_uid"], rows_per_key="_rows")


def drop_short(df: DataFrame, settings: Settings) -> DataFrame:
    return df.filter(keep_unless(too_short(settings)))


def drop_no_energy(df: DataFrame) -> DataFrame:
    return df.filter(keep_unless(without_energy()))


def drop_long(df: DataFrame, settings: Settings) -> DataFrame:
    return df.filter(keep_unless(too_long(settings)))


def active_life_filter(df: DataFrame, settings: Settings) -> DataFrame:
    """Drops points that were used for too small a share of their lifetime."""
    points = df.groupBy("evse_uid").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("duration_seconds").alias("_used"),
        F.min("started_at").alias("_first"),
        F.max("stopped_at").alias("_last"),
    )
    idle = used_share(F.col("_used"), F.col("_first"), F.col("_last")) < settings.active_life
    return _drop_points(df, points, idle)


def charger_type(df: DataFrame, settings: Settings) -> DataFrame:
    """Keeps the points of one type; an unknown type is dropped."""
    return df.filter(F.col("type") == settings.point_type)


def min_sessions(df: DataFrame, settings: Settings) -> DataFrame:
    """Drops points with few sessions."""
    points = df.groupBy("evse_uid").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("started_at").alias("_sessions")
    )
    return _drop_points(df, points, F.col("_sessions") < settings.min_sessions)


def _drop_points(df: DataFrame, points: DataFrame, condition: Column) -> DataFrame:
    verdicts = points.select("evse_uid", "_rows", (~keep_unless(condition)).alias("_drop"))
    return (
        attach(df, verdicts, ["evse_uid"], rows_per_key="_rows")
        .filter(keep_unless(F.col("_drop")))
        .drop("_drop")
    )
