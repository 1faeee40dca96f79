"""Row repairs on the session log. All but the removal of copies are narrow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.functions.times import plus_seconds, seconds_between


def drop_copies(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; copies are removed on the map side before the shuffle."""
    return df.dropDuplicates()


def fix_end_before_start(df: DataFrame) -> DataFrame:
    """An energy end before the start becomes the stop, which may be NULL at this point."""
    lec = F.col("last_energy_change_at")
    return df.withColumn(
        "last_energy_change_at",
        F.when(lec < F.col("started_at"), F.col("stopped_at")).otherwise(lec),
    )


def infer_stop(df: DataFrame) -> DataFrame:
    """A missing stop is the start plus the duration."""
    inferred = plus_seconds(F.col("started_at"), F.col("duration_seconds"))
    return df.withColumn("stopped_at", F.coalesce("stopped_at", inferred))


def fill_energy_end(df: DataFrame) -> DataFrame:
    return df.withColumn("last_energy_change_at", F.coalesce("last_energy_change_at", "stopped_at"))


def correct_duration(df: DataFrame) -> DataFrame:
    """The duration is what lies between start and stop, whatever the log says."""
    return df.withColumn("duration_seconds", seconds_between(F.col("started_at"), F.col("stopped_at")))
