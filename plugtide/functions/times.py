"""Date and duration expressions on zone-less timestamps.

Differences are whole microseconds (`bigint`) until the last division, so that sums do not depend
on the order in which Spark adds them. Nothing here looks at the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plugtide.config import MONTH_TO_SEASON, MONTHS, WEEKDAYS

MICROS = 1_000_000


def micros_between(start: Column, end: Column) -> Column:
    # Interval by interval, whole quotient: exact microseconds for any pair of timestamps.
    return F.call_function("div", end - start, F.expr("interval '0.000001' second"))


def seconds_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS))


def midnight(date: Column) -> Column:
    return date.cast("timestamp_ntz")


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def weekday_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(date) + 1)


def month_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(date))


def season_name(month: Column) -> Column:
    seasons = F.create_map(*[F.lit(x) for pair in MONTH_TO_SEASON.items() for x in pair])
    return F.coalesce(F.try_element_at(seasons, month), month)
