"""Input schemas and the required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SESSIONS = T.StructType([
    T.StructField("evse_uid", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("stopped_at", T.TimestampNTZType()),
    T.StructField("last_energy_change_at", T.TimestampNTZType()),
    T.StructField("energy_wh", T.DoubleType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("location_city", T.StringType()),
    T.StructField("country", T.StringType()),
])
POINTS = T.StructType([
    T.StructField("evse_uid", T.StringType()),
    T.StructField("type", T.StringType()),
])


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df
