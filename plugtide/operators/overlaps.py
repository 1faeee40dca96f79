"""Sessions that run into the next one at the same point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plugtide.functions.times import MICROS, micros_between, midnight

HOUR = 3600 * MICROS


def fix_overlaps(df: DataFrame) -> DataFrame:
    """A session that stops after the next one starts stops at its last energy change instead.

    Only the neighbour's start is read, which never changes, so one look ahead is enough. The look
    ahead is split by start hour: inside an hour it is a window, and an hour's last session looks at
    the first start of the point's next hour in use, from a table with one row per point and hour.
    A point with a very long or dense history is thus spread over as many groups as it has hours.
    """
    # A session without a start has no neighbour and stays as it is.
    known = df.filter(F.col("evse_uid").isNotNull())
    unknown = known.filter(F.col("started_at").isNull())
    hour = F.floor(micros_between(midnight(F.lit("1970-01-01").cast("date")), F.col("started_at")) / HOUR)
    # An hour that is never NULL keeps the two uses of the table below identical, so that Spark runs
    # what leads to it once.
    known = known.filter(F.col("started_at").isNotNull()).withColumn("_hour", F.coalesce(hour, F.lit(0)))
    ordered = Window.partitionBy("evse_uid", "_hour").orderBy(
        "started_at", "stopped_at", "last_energy_change_at", "energy_wh"
    )
    next_hours = (
        known.groupBy("evse_uid", "_hour")
        .agg(F.min("started_at").alias("_first"))
        .select(
            "evse_uid",
            "_hour",
            F.lead("_first").over(Window.partitionBy("evse_uid").orderBy("_hour")).alias("_next_hour_start"),
        )
    )
    next_start = F.coalesce("_next_start", "_next_hour_start")
    looked_at = (
        known.withColumn("_next_start", F.lead("started_at").over(ordered))
        .join(next_hours, ["evse_uid", "_hour"], "left")
        .withColumn(
            "stopped_at",
            F.when(F.col("stopped_at") > next_start, F.col("last_energy_change_at")).otherwise(
                F.col("stopped_at")
            ),
        )
        .drop("_hour", "_next_start", "_next_hour_start")
    )
    return looked_at.unionByName(unknown)
