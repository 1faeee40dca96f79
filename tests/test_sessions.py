"""Repairs, filters, overlaps, splitting and allocation on hand-made sessions."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plugtide.config import Settings
from plugtide.operators import enrich, expand, filters, overlaps, repair
from tests.conftest import ts

LOG = (
    "evse_uid string, started_at timestamp_ntz, stopped_at timestamp_ntz, "
    "last_energy_change_at timestamp_ntz, energy_wh double, duration_seconds double"
)
SETTINGS = Settings(remove_before="2024-01-05", remove_after="2024-01-28")


def test_repairs_in_order_fill_from_the_inferred_stop(table):
    df = table(LOG, [
        ("a", "2024-01-06 10:00:00", None, "2024-01-06 09:00:00", 5.0, 90.5),
        ("b", "2024-01-06 10:00:00", "2024-01-06 10:30:00", None, 5.0, None),
        ("c", None, "2024-01-06 10:30:00", "2024-01-06 10:20:00", 5.0, 60.0),
    ])
    for step in (repair.fix_end_before_start, repair.infer_stop, repair.fill_energy_end, repair.correct_duration):
        df = step(df)
    rows = {r["evse_uid"]: r for r in df.collect()}
    # The energy end before the start became the unknown stop, later the inferred one.
    assert rows["a"]["last_energy_change_at"] == rows["a"]["stopped_at"] == datetime(2024, 1, 6, 10, 1, 30, 500000)
    assert rows["a"]["duration_seconds"] == 90.5
    assert rows["b"]["last_energy_change_at"] == ts("2024-01-06 10:30:00")
    assert rows["b"]["duration_seconds"] == 1800.0
    assert rows["c"]["duration_seconds"] is None


def test_copies_with_nulls_are_equal(table):
    row = ("a", "2024-01-06 10:00:00", None, None, 5.0, None)
    assert repair.drop_copies(table(LOG, [row, row, row])).count() == 1


def test_filters_keep_rows_with_unknown_values(table):
    df = table(LOG, [
        ("null", None, None, None, None, None),
        ("old", "2019-01-06 10:00:00", None, None, 1.0, 60.0),
        ("short", "2024-01-06 10:00:00", None, None, 1.0, 29.0),
        ("edge", "2024-01-06 10:00:00", None, None, 1.0, 30.0),
        ("none", "2024-01-06 10:00:00", None, None, 0.0, 60.0),
        ("long", "2024-01-06 10:00:00", None, None, 1.0, 172801.0),
    ])
    def left(out):
        return {r["evse_uid"] for r in out.collect()}

    everything = left(df)
    assert left(filters.drop_old(df, SETTINGS)) == everything - {"old"}
    assert left(filters.drop_short(df, SETTINGS)) == everything - {"short"}
    assert left(filters.drop_no_energy(df)) == everything - {"none"}
    assert left(filters.drop_long(df, SETTINGS)) == everything - {"long"}
    assert "null" not in left(filters.desired_range(df, SETTINGS))


def test_active_days_look_outside_the_range(table):
    df = table(LOG, [
        ("a", "2024-01-02 10:00:00", None, None, 1.0, 60.0),
        ("a", "2024-01-03 10:00:00", None, None, 1.0, 60.0),
        ("a", "2024-01-06 10:00:00", None, None, 1.0, 60.0),
        ("a", "2024-01-30 10:00:00", None, None, 1.0, 60.0),
        ("b", "2024-01-07 10:00:00", None, None, 1.0, 60.0),
        ("b", "2024-01-28 00:00:00", None, None, 1.0, 60.0),
    ])
    rows = {r["evse_uid"]: r for r in filters.desired_range(df, SETTINGS).collect()}
    assert len(rows) == 2
    a, b = rows["a"], rows["b"]
    assert (a["first_active_day"], a["final_active_day"]) == (date(2024, 1, 2), date(2024, 1, 30))
    assert a["last_session_pre_data"] == date(2024, 1, 3)
    assert b["last_session_pre_data"] == b["first_active_day"] == date(2024, 1, 7)


def test_point_filters(table):
    idle = [("idle", "2024-01-06 00:00:00", "2024-01-06 00:01:00", None, 1.0, 60.0),
            ("idle", "2024-01-20 00:00:00", "2024-01-20 00:01:00", None, 1.0, 60.0)]
    busy = [("busy", f"2024-01-06 {h:02d}:00:00", f"2024-01-06 {h:02d}:50:00", None, 1.0, 3000.0) for h in range(12)]
    point = [("zero", "2024-01-06 00:00:00", "2024-01-06 00:00:00", None, 1.0, 0.0)]
    df = table(LOG, idle + busy + point)
    kept = {r["evse_uid"] for r in filters.active_life_filter(df, SETTINGS).collect()}
    assert kept == {"busy", "zero"}  # a lifetime of zero has no share and stays
    few = Settings(min_sessions=3)
    assert {r["evse_uid"] for r in filters.min_sessions(df, few).collect()} == {"busy"}


def test_overlap_looks_at_the_next_start_only(table):
    df = table(LOG, [
        ("a", "2024-01-06 10:00:00", "2024-01-06 12:00:00", "2024-01-06 11:30:00", 1.0, 7200.0),
        ("a", "2024-01-06 11:00:00", "2024-01-06 11:10:00", "2024-01-06 11:05:00", 1.0, 600.0),
        ("a", "2024-01-06 23:00:00", "2024-01-08 09:00:00", "2024-01-09 01:00:00", 1.0, 600.0),
        ("a", "2024-01-08 08:00:00", "2024-01-08 09:00:00", None, 1.0, 600.0),
        ("b", "2024-01-08 08:30:00", "2024-01-08 09:00:00", "2024-01-08 08:40:00", 1.0, 600.0),
        (None, "2024-01-08 08:30:00", "2024-01-08 09:00:00", None, 1.0, 600.0),
    ])
    out = {(r["evse_uid"], r["started_at"]): r["stopped_at"] for r in overlaps.fix_overlaps(df).collect()}
    assert len(out) == 5
    assert out["a", ts("2024-01-06 10:00:00")] == ts("2024-01-06 11:30:00")
    assert out["a", ts("2024-01-06 11:00:00")] == ts("2024-01-06 11:10:00")
    # across days, and the stop may move later
    assert out["a", ts("2024-01-06 23:00:00")] == ts("2024-01-09 01:00:00")
    assert out["a", ts("2024-01-08 08:00:00")] == ts("2024-01-08 09:00:00")
    assert out["b", ts("2024-01-08 08:30:00")] == ts("2024-01-08 09:00:00")


def split(table, *rows):
    df = enrich.charging_time(enrich.energy_kwh(table(LOG, list(rows))))
    df = enrich.session_dates(enrich.time_features(df, "started_at"))
    return expand.split_days(df)


def test_session_over_two_midnights(table):
    rows = split(
        table, ("a", "2024-01-06 22:00:00", "2024-01-08 03:00:00", "2024-01-07 06:00:00", 8000.0, 104400.0)
    ).orderBy("session_date").collect()
    assert [r["session_date"] for r in rows] == [date(2024, 1, d) for d in (6, 7, 8)]
    assert [r["session_charging_duration"] for r in rows] == [7200.0, 21600.0, 0.0]
    assert [r["energy_wh"] for r in rows] == [2000.0, 6000.0, 0.0]
    assert [r["session_duration"] for r in rows] == [7200, 86400, 10800]
    assert sum(r["session_duration"] for r in rows) == 104400
    assert rows[0]["stopped_at"] == ts("2024-01-06 23:59:59")
    assert rows[1]["started_at"] == ts("2024-01-07 00:00:00")
    assert [r["last_energy_change_at"] for r in rows] == [
        ts("2024-01-06 23:59:59"), ts("2024-01-07 06:00:00"), None
    ]
    assert [r["weekday"] for r in rows] == ["Saturday", "Sunday", "Monday"]
    assert {r["month"] for r in rows} == {"January"}


def test_backward_and_single_day_sessions(table):
    rows = split(
        table,
        ("back", "2024-01-06 22:00:00", "2024-01-05 03:00:00", "2024-01-06 22:30:00", 1.0, 1.0),
        ("one", "2024-01-06 22:00:00", "2024-01-06 23:59:59", "2024-01-06 22:30:00", 1.0, 1.0),
        ("zero", "2024-01-06 22:00:00", "2024-01-07 01:00:00", "2024-01-06 22:00:00", 1.0, 1.0),
    ).collect()
    found = {(r["evse_uid"], r["session_date"].day): r for r in rows}
    assert set(found) == {("one", 6), ("zero", 6), ("zero", 7)}
    assert found["one", 6]["session_duration"] is None
    assert found["zero", 6]["energy_wh"] is None  # no charging time to share the energy over
    assert found["zero", 7]["energy_wh"] == 0.0


def test_period_allocation_bounds(table):
    df = split(
        table,
        ("end", "2024-01-06 20:00:00", "2024-01-06 23:59:59", "2024-01-06 22:30:00", 1.0, 1.0),
        ("over", "2024-01-06 11:00:00", "2024-01-07 01:00:00", "2024-01-06 22:30:00", 1.0, 1.0),
        ("open", "2024-01-06 11:00:00", None, None, 1.0, 1.0),
    )
    out = expand.period_allocation(df)
    use = {(r["evse_uid"], r["session_date"].day, r["day_period"]): r["usage_time"] for r in out.collect()}
    assert use["end", 6, "evening"] == 3600.0 and use["end", 6, "night"] == 10800.0
    assert use["over", 6, "morning"] == 3600.0 and use["over", 6, "afternoon"] == 18000.0
    assert use["over", 7, "early_morning"] == 3600.0
    assert use["open", 6, "morning"] is None
    total = out.filter("evse_uid = 'over'").agg(F.sum("usage_time")).first()[0]
    assert total == 14 * 3600


@pytest.mark.parametrize(
    "population, expected",
    [(None, "Village"), (0, "Village"), (9999, "Village"), (10000, "Town"), (1000000, "Metropolis")],
)
def test_city_type(table, population, expected):
    assert enrich.city_type(table("population bigint", [(population,)])).first()["city_type"] == expected


def test_holidays_of_the_own_country(table):
    holidays = table("country string, holiday_date date", [("GB", "2024-01-10"), ("GB", "2024-01-11"), ("FR", "2024-01-20")])
    df = table("country string, started_at timestamp_ntz", [
        ("GB", "2024-01-08 23:00:00"), ("GB", "2024-01-07 23:00:00"), ("GB", "2024-01-20 00:00:00"),
        ("FR", "2024-01-22 10:00:00"), (None, "2024-01-10 10:00:00"),
    ])
    out = enrich.holiday_flag(df, holidays, radius_days=2).orderBy("started_at").collect()
    assert [r["holiday_period"] for r in out] == [0, 1, 0, 0, 1]


def random_log(seed: int, points: int, count: int) -> list[tuple]:
    """Sessions of up to three days; half of them start on a full quarter of an hour, so starts collide."""
    rng, rows = random.Random(seed), []
    for _ in range(count):
        start = datetime(2024, 1, 6) + timedelta(seconds=rng.randrange(0, 4 * 86400))
        if rng.random() < 0.5:
            start = start.replace(minute=start.minute // 15 * 15, second=0)
        length = rng.randrange(1, 3 * 86400)
        stop = start + timedelta(seconds=length)
        lec = start + timedelta(seconds=rng.randrange(0, length + 600))
        rows.append((f"p{rng.randrange(points)}", str(start), str(stop), str(lec), float(rng.randrange(1, 9999)), float(length)))
    return rows


def test_overlaps_against_a_plain_loop(table):
    rows = random_log(7, 3, 300)
    expected, by_point = [], defaultdict(list)
    for p, start, stop, lec, wh, _ in rows:
        by_point[p].append((start, stop, lec, wh))
    for p, sessions in by_point.items():
        sessions.sort()
        for i, (start, stop, lec, wh) in enumerate(sessions):
            overlaps_next = i + 1 < len(sessions) and stop > sessions[i + 1][0]
            expected.append((p, start, lec if overlaps_next else stop, wh))
    out = overlaps.fix_overlaps(table(LOG, rows))
    got = [(r["evse_uid"], str(r["started_at"]), str(r["stopped_at"]), r["energy_wh"]) for r in out.collect()]
    assert sorted(got) == sorted(expected)


def test_split_and_allocation_lose_no_second(table):
    rows = [(f"{i}", *r[1:]) for i, r in enumerate(random_log(11, 1, 200)) if not r[2].endswith("23:59:59")]
    parts = split(table, *rows)
    per_session = parts.groupBy("evse_uid").agg(F.count("*").alias("days"), F.sum("session_duration").alias("s"))
    by_id = {r["evse_uid"]: r for r in per_session.collect()}
    use = expand.period_allocation(parts).groupBy("evse_uid").agg(F.sum("usage_time").alias("used"))
    times = {r[0]: (ts(r[1]), ts(r[2])) for r in rows}
    for r in use.collect():
        start, stop = times[r["evse_uid"]]
        length = (stop - start).total_seconds()
        assert r["used"] == length
        days = (stop.date() - start.date()).days + 1
        assert by_id[r["evse_uid"]]["days"] == days
        assert days == 1 or by_id[r["evse_uid"]]["s"] == length
