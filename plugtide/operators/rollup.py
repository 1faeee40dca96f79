"""Points rolled up to their station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.operators.grid import busyness_category, first_known


def station_rollup(df: DataFrame, settings: Settings) -> DataFrame:
    """One row per (day, period, station), with the category of the mean busyness.

    The grouping key carries day and period and partial sums are formed before the shuffle, so a
    station with very many points is no hot spot. First values are taken in the order of points.
    """
    stations = (
        df.filter(F.col("location_name").isNotNull())
        .groupBy("session_date", "day_period", "location_name")
        .agg(
            F.min("first_active_day").alias("first_active_day"),
            F.min("gap_days").alias("gap_days"),
            F.sum("usage_time").alias("usage_time"),
            *[first_known(c, order="evse_uid") for c in config.STATION_FIRSTS],
            *[F.avg(c).alias(c) for c in config.STATION_MEANS],
        )
    )
    return stations.withColumn(
        "daily_period_busyness_cat", busyness_category(F.col("daily_period_busyness"), settings)
    )
