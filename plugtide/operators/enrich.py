"""Columns added to sessions: energy, power, calendar, holidays, city type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide import config
from plugtide.functions.bins import left_closed
from plugtide.functions.lookups import attach
from plugtide.functions.times import micros_between, month_name, season_name, seconds_between, weekday_name


def types_by_point(points: DataFrame) -> DataFrame:
    """One type per point, the least one where the point table disagrees with itself."""
    return points.groupBy("evse_uid").agg(F.min("type").alias("type"))


def merge_type(df: DataFrame, points: DataFrame) -> DataFrame:
    return attach(df, types_by_point(points), ["evse_uid"])


def energy_kwh(df: DataFrame) -> DataFrame:
    return df.withColumn("energy_kwh", F.col("energy_wh") / 1000)


def charging_time(df: DataFrame) -> DataFrame:
    """Seconds from the start to the last energy change."""
    charging = seconds_between(F.col("started_at"), F.col("last_energy_change_at"))
    return df.withColumn("session_charging_duration", charging)


def average_kw(kwh: Column, charging_s: Column) -> Column:
    return F.try_divide(kwh, charging_s / 3600)


def _power_by(df: DataFrame, key: str, name: str) -> DataFrame:
    kwh = F.coalesce(F.sum("energy_kwh"), F.lit(0.0))
    # Whole microseconds keep the sum of durations independent of the order of addition.
    micros = F.sum(micros_between(F.col("started_at"), F.col("last_energy_change_at")))
    charging_s = F.coalesce(micros, F.lit(0)) / F.lit(1e6)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), average_kw(kwh, charging_s).alias(name))


def station_avg_power(df: DataFrame) -> DataFrame:
    """Average kW per station: energy over charging hours."""
    power = _power_by(df, "location_name", "station_avg_power")
    return attach(df, power, ["location_name"], rows_per_key="_rows")


def point_avg_power(df: DataFrame) -> DataFrame:
    """Average kW per point."""
    power = _power_by(df, "evse_uid", "point_avg_power")
    return attach(df, power, ["evse_uid"], rows_per_key="_rows")


def station_points(df: DataFrame) -> DataFrame:
    """Number of different points per station.

    Points are first reduced to one row per station and point, so the second grouping is small.
    """
    points = (
        df.groupBy("location_name", "evse_uid")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("location_name")
        .agg(F.sum("_rows").alias("_rows"), F.count("evse_uid").alias("station_charging_points"))
    )
    return attach(df, points, ["location_name"], rows_per_key="_rows")


def time_features(df: DataFrame, date_col: str) -> DataFrame:
    """Names of weekday, month and season, and numbers of quarter and year, of a date column."""
    date = F.to_date(date_col)
    return df.withColumns({
        "weekday": weekday_name(date),
        "month": month_name(date),
        "quarter": F.quarter(date),
        "season": season_name(month_name(date)),
        "year": F.year(date),
    })


def session_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "session_date": F.to_date("started_at"),
        "end_date": F.to_date("stopped_at"),
    })


def holiday_dates(holidays: DataFrame, radius_days: int) -> DataFrame:
    """Every (country, date) within the radius of a holiday, once."""
    near = F.sequence(
        F.date_sub("holiday_date", radius_days), F.date_add("holiday_date", radius_days)
    )
    return holidays.select("country", F.explode(near).alias("_date")).distinct()


def holiday_flag(
    df: DataFrame, holidays: DataFrame, date_col: str = "started_at", radius_days: int = 2
) -> DataFrame:
    """1 where a holiday of the row's country lies within the radius, else 0.

    The range condition becomes an equality on exploded dates, whose table is limited by the
    calendar (countries x days).
    """
    near = holiday_dates(holidays, radius_days).withColumn("_near", F.lit(1))
    dated = df.drop("holiday_period").withColumn("_date", F.to_date(date_col))
    return (
        attach(dated, near, ["country", "_date"])
        .withColumn("holiday_period", F.coalesce("_near", F.lit(0)))
        .drop("_date", "_near")
    )


def population_join(df: DataFrame, population: DataFrame) -> DataFrame:
    """Population of the row's city; rows without a city or a country are dropped.

    Where the population table names a city twice, the larger number counts.
    """
    known = df.filter(F.col("location_city").isNotNull() & F.col("country").isNotNull())
    city = ["location_city", "country"]
    return attach(known, population.groupBy(*city).agg(F.max("population").alias("population")), city)


def city_type_of(population: Column) -> Column:
    unknown = population.isNull() | (population == 0)
    known = F.when(unknown, F.lit(config.UNKNOWN_POPULATION)).otherwise(population)
    return left_closed(known, config.CITY_BINS)


def city_type(df: DataFrame) -> DataFrame:
    """Small places are often missing or zero: those count as 1,000 people."""
    unknown = F.col("population").isNull() | (F.col("population") == 0)
    return df.withColumns({
        "population": F.when(unknown, F.lit(config.UNKNOWN_POPULATION)).otherwise(F.col("population")),
        "city_type": city_type_of(F.col("population")),
    })
