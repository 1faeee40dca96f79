"""The calendar grid, gap days, rolling features and their two rule sets."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.operators import grid, rolling

COMPAT = Settings(remove_before="2024-01-05", remove_after="2024-01-28")
FIXED = replace(COMPAT, compat=False)

AGG = (
    "session_date date, day_period string, evse_uid string, usage_time double, type string, "
    "first_active_day date, final_active_day date, last_session_pre_data date, period_duration bigint, "
    "country string, location_city string, location_name string, city_type string, "
    "station_charging_points bigint, station_avg_power double, point_avg_power double, "
    "avg_total_busyness double, avg_day_period_busyness double"
)
LENGTHS = {n: x for n, _, _, x in config.DAY_PERIODS}


@pytest.fixture
def filled(table):
    def make(point, days: dict, settings, first="2024-01-02", final="2024-01-12"):
        """A grid from {date: {period: seconds}}; the periods of a day are always complete."""
        rows = [
            (d, p, point, float(use.get(p, 0)), "public", first, final, "2024-01-03", LENGTHS[p], "GB", "C", "S",
             "Town", 1, 7.0, 7.0, 0.5, LENGTHS[p] / 100000)
            for d, use in days.items() for p in config.PERIOD_NAMES
        ]
        holidays = table("country string, holiday_date date", [("GB", "2024-01-09")])
        agg = grid.period_busyness(table(AGG, rows), settings)
        return grid.operation_time(grid.fill_grid(agg, holidays, settings))

    return make


def cell(df, column):
    return {(r["session_date"].day, r["day_period"]): r[column] for r in df.collect()}


def test_grid_is_complete_and_runs_to_the_final_day(filled):
    out = filled("a", {"2024-01-07": {"night": 100}, "2024-01-09": {"morning": 50}}, COMPAT)
    assert out.count() == 8 * 5  # 5th (start of the range) to 12th (final day)
    use = cell(out, "usage_time")
    assert use[7, "night"] == 100 and use[8, "night"] == 0 and sum(use.values()) == 150
    assert {r["day_period"]: r["n"] for r in out.groupBy("day_period").agg(F.count("*").alias("n")).collect()} == {
        p: 8 for p in config.PERIOD_NAMES
    }
    assert out.filter("daily_period_busyness_cat IS NULL OR type IS NULL OR avg_day_period_busyness IS NULL").count() == 0


@pytest.mark.parametrize("settings, last", [(COMPAT, date(2024, 2, 3)), (FIXED, date(2024, 1, 27))])
def test_grid_past_the_range(filled, settings, last):
    out = filled("a", {"2024-01-20": {"night": 100}}, settings, final="2024-02-03")
    assert out.agg(F.max("session_date")).first()[0] == last


def test_grid_starts_at_a_first_day_inside_the_range(filled):
    out = filled("a", {"2024-01-10": {"night": 100}}, COMPAT, first="2024-01-08", final="2024-01-10")
    assert out.agg(F.min("session_date"), F.max("session_date")).first() == (date(2024, 1, 8), date(2024, 1, 10))


def test_period_length_on_idle_days(filled):
    days = {"2024-01-07": {"night": 100}, "2024-01-09": {"morning": 50}}
    compat, fixed = (cell(filled("a", days, s), "period_duration") for s in (COMPAT, FIXED))
    assert compat[7, "morning"] == 21600
    assert compat[8, "morning"] == 10800  # the row before an idle day is the night
    assert compat[5, "morning"] == 18000  # leading days take the next row: the afternoon
    assert all(fixed[d, p] == LENGTHS[p] for d, p in fixed)


def test_gap_days_see_five_rows_back(filled):
    out = cell(filled("a", {"2024-01-07": {"night": 100}, "2024-01-08": {"morning": 50}}, COMPAT), "gap_days")
    assert out[5, "morning"] == 2 and out[6, "night"] == 3  # since the last session before the range
    assert out[8, "morning"] == 5  # yesterday's night comes later in alphabetical order
    assert out[8, "night"] == 1
    assert out[9, "morning"] == 1 and out[9, "afternoon"] == 2


@pytest.mark.parametrize(
    "use, compat, fixed",
    [(0.0, "Not Busy", "Not Busy"), (2159.9, "Not Busy", "Not Busy"), (2160.0, "Busy", "Busy"),
     (21600.0, "Busy", "Busy"), (21816.0, None, "Busy")],
)
def test_busyness_bins(table, use, compat, fixed):
    df = table("day_period string, usage_time double", [("morning", use)])
    for settings, expected in ((COMPAT, compat), (FIXED, fixed)):
        assert grid.period_busyness(df, settings).first()["daily_period_busyness_cat"] == expected


def test_rolling_against_plain_python(filled):
    days = {f"2024-01-{d:02d}": {"morning": 700 * (d % 5), "night": 100 * d} for d in range(5, 13)}
    grid_rows = filled("a", days, FIXED)
    out = rolling.rolling_iqr(rolling.rolling_period(rolling.rolling_daily(grid_rows)), FIXED)
    out = rolling.cumulative_daily(rolling.past_week(out))
    rows = {(r["session_date"].day, r["day_period"]): r for r in out.collect()}
    day_use = {d: (700 * (d % 5) + 100 * d) / 86400 for d in range(5, 13)}
    for d in range(5, 13):
        before = [day_use[x] for x in range(5, d)]
        row = rows[d, "morning"]
        assert row["daily_busyness"] == pytest.approx(day_use[d])
        assert row["daily_rolling_avg_1d"] == pytest.approx(before[-1] if before else 0)
        assert row["daily_rolling_avg_7d"] == pytest.approx(sum(before[-7:]) / len(before[-7:]) if before else 0)
        assert row["daily_cumulative_average"] == pytest.approx(sum(before) / len(before) if before else 0)
        past = [700 * (x % 5) / 21600 for x in range(5, d)]
        assert row["past_week_same_period"] == pytest.approx(past[-7] if len(past) >= 7 else 0)
        values = sorted(past[-7:])

        def quantile(q):
            at = (len(values) - 1) * q
            low = int(at)
            return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)

        iqr = quantile(0.75) - quantile(0.25) if values else 0
        assert row["daily_period_rolling_IQR_7d"] == pytest.approx(iqr)


def test_spread_crosses_groups_in_compat_only(filled):
    days = {f"2024-01-{d:02d}": {"morning": 700 * (d % 5), "night": 100 * d} for d in range(5, 13)}
    both = filled("a", days, COMPAT).unionByName(filled("b", days, COMPAT))
    compat = {(r["evse_uid"], r["session_date"].day, r["day_period"]): r["daily_period_rolling_IQR_7d"]
              for r in rolling.rolling_iqr(both, COMPAT).collect()}
    fixed = {(r["evse_uid"], r["session_date"].day, r["day_period"]): r["daily_period_rolling_IQR_7d"]
             for r in rolling.rolling_iqr(both, FIXED).collect()}
    changed = {k for k in compat if compat[k] != pytest.approx(fixed[k])}
    assert compat["a", 5, "afternoon"] == 0
    assert compat["b", 5, "afternoon"] == pytest.approx(300 / 10800)  # last night of the point before
    assert changed == {("b", 5, "afternoon"), ("a", 5, "night"), ("b", 5, "night")}


def test_missing_columns_are_named(table):
    with pytest.raises(ValueError, match="day_period"):
        grid.aggregate_by_point(table("session_date date, evse_uid string", [("2024-01-05", "a")]))
