from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from plugtide.config import Settings
from plugtide.operators import enrich, evaluate, holidays
from plugtide.plans import catalog, stages
from plugtide.plans.fixture import Fixture
from plugtide.sources import tables

SF = "/root/testdata/sf0.001"


# --- the table that is kept --------------------------------------------------------------------------

class Kept:
    """A table of squares per bucket, and what was worked out for it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.asked = spark, str(path / "kept"), []

    def refresh(self, values: dict[int, list[int]], fingerprint="f"):
        rows = [(b, v) for b, own in values.items() for v in own]
        frame = self.spark.createDataFrame(rows, "bucket int, v long")

        def compute(buckets):
            self.asked.append(buckets)
            own = frame.filter(F.col("bucket").isin(buckets)) if buckets else frame.limit(0)
            return own.select((F.col("v") * F.col("v")).alias("square"), "bucket")

        marks = tables.bucket_marks(frame, "bucket")
        got = tables.refresh(self.spark, self.path, fingerprint, marks, compute)
        return sorted(r.square for r in got.collect())


def test_only_changed_buckets_are_written_anew(spark, tmp_path):
    kept = Kept(spark, tmp_path)
    assert kept.refresh({0: [1, 2], 1: [3], 2: [4, 4]}) == [1, 4, 9, 16, 16]
    before = {p.name for p in (tmp_path / "kept").glob("bucket=0/part-*")}
    assert kept.refresh({0: [2, 1], 1: [3, 5], 3: [6]}) == [1, 4, 9, 25, 36]
    assert kept.asked == [[0, 1, 2], [1, 3]]
    assert before == {p.name for p in (tmp_path / "kept").glob("bucket=0/part-*")}
    assert kept.refresh({0: [1, 2], 1: [3, 5], 3: [6]}) == [1, 4, 9, 25, 36] and len(kept.asked) == 2
    assert kept.refresh({1: [3, 5]}) == [9, 25] and len(kept.asked) == 2


def test_another_fingerprint_uses_nothing(spark, tmp_path):
    kept = Kept(spark, tmp_path)
    kept.refresh({0: [1], 1: [2]})
    assert kept.refresh({1: [2]}, "other") == [4]
    assert kept.asked == [[0, 1], [1]]
    assert kept.refresh({}, "third") == []


def test_an_interrupted_refresh_is_made_up_for(spark, tmp_path):
    kept = Kept(spark, tmp_path)
    kept.refresh({0: [1], 1: [2]})
    values = {0: [1], 1: [2, 3]}
    frame = spark.createDataFrame([(b, v) for b, own in values.items() for v in own], "bucket int, v long")

    def broken(buckets):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        tables.refresh(spark, kept.path, "f", tables.bucket_marks(frame, "bucket"), broken)
    # Even the old rows of bucket 1 count as unknown now.
    assert kept.refresh({0: [1], 1: [2]}) == [1, 4]
    assert kept.asked == [[0, 1], [1]]
    for part in (tmp_path / "kept" / "_manifest").glob("*SUCCESS"):
        part.unlink()
    assert kept.refresh({0: [1], 1: [2]}) == [1, 4] and kept.asked[-1] == [0, 1]


def test_a_table_of_other_settings_is_not_read_back(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def compute(value):
        calls.append(value)
        return spark.createDataFrame([(value,)], "v int")

    one, two = (tables.settings_mark(Settings(min_sessions=n)) for n in (30, 31))
    assert tables.settings_mark(Settings()) == one != two
    for value, mark in ((1, one), (2, one), (3, two), (4, two)):
        got = tables.read_or_compute(spark, path, lambda: compute(value), fingerprint=mark).first().v
    assert calls == [1, 3] and got == 3


def test_marks_do_not_depend_on_order(spark):
    rows = [(k % 5, k, None if k % 3 else "x") for k in range(50)]
    schema = "bucket int, v long, s string"
    one, two = spark.createDataFrame(rows, schema), spark.createDataFrame(rows[::-1], schema).repartition(7)
    assert tables.table_mark(one) == tables.table_mark(two) != tables.table_mark(one.limit(49))
    assert tables.bucket_marks(one, "bucket") == tables.bucket_marks(two, "bucket")


def test_features_are_refreshed_where_sessions_changed(spark, tmp_path, monkeypatch):
    """The result is that of a full run, and most buckets are left as they are."""
    fx, settings, asked = Fixture(spark, SF), catalog.REPAIRED, []
    own = tables.refresh
    monkeypatch.setattr(tables, "refresh", lambda s, p, f, m, compute, *a: own(s, p, f, m, lambda b: (asked.append(b), compute(b))[1], *a))
    want = stages.point_features(fx.sessions, fx.points, fx.holidays, fx.population, settings).cache()
    used = want.filter("usage_time > 0 AND session_date >= '2024-01-25'").first().evse_uid
    first = fx.sessions.filter(~((F.col("evse_uid") == used) & (F.col("started_at") >= "2024-01-24")))

    def run(sessions, settings):
        path = str(tmp_path / "features")
        return stages.refreshed_features(path, sessions, fx.points, fx.holidays, fx.population, settings)

    run(first, settings)
    got = run(fx.sessions, settings)
    keys = ["evse_uid", "session_date", "day_period", "usage_time", "station_avg_power", "weekly_cumulative_average"]
    assert sorted(map(str, got.select(keys).collect())) == sorted(map(str, want.select(keys).collect()))
    assert len(asked[1]) < len(asked[0])
    run(fx.sessions, replace(settings, holiday_radius_days=0))
    assert asked[2] == asked[0]


# --- holidays by rules -----------------------------------------------------------------------------

def days(spark, country, *years):
    frame = spark.createDataFrame([(y,) for y in years], "y int")
    return sorted(r.holiday_date for r in holidays.holiday_calendar(spark, frame, [country]).collect())


def test_easter(spark):
    known = {1961: (4, 2), 1981: (4, 19), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25), 2076: (4, 19)}
    frame = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r.y: r.e for r in frame.select("y", holidays.easter_sunday(F.col("y")).alias("e")).collect()}
    assert got == {y: date(y, *d) for y, d in known.items()}


def test_known_years(spark):
    assert days(spark, "GB", 2022) == [
        date(2022, m, d) for m, d in
        [(1, 1), (1, 3), (4, 15), (4, 18), (5, 2), (6, 2), (6, 3), (8, 29), (9, 19), (12, 25), (12, 26), (12, 27)]
    ]
    # Christmas on a Saturday: both days are kept on Monday and Tuesday too.
    assert [d for d in days(spark, "GB", 2021) if d.month == 12] == [date(2021, 12, d) for d in (25, 26, 27, 28)]
    assert days(spark, "US", 2021)[-4:] == [date(2021, 11, 11), date(2021, 11, 25), date(2021, 12, 24), date(2021, 12, 25)]
    assert date(2024, 5, 9) in days(spark, "FR", 2024) and date(2024, 5, 20) in days(spark, "DE", 2024)


def test_years_without_rules_and_unknown_countries(spark):
    frame = spark.createDataFrame([(None,), (2024,), (2024,), (1850,)], "y int")
    got = holidays.holiday_calendar(spark, frame, ["FR"]).collect()
    assert len(got) == len(set(got)) == 11
    with pytest.raises(ValueError, match="XX"):
        holidays.holiday_calendar(spark, frame, ["XX"])
    assert holidays.holiday_calendar(spark, frame.limit(0)).collect() == []


def test_flags_at_the_turn_of_a_year(spark, table):
    rows = table("country string, started_at timestamp_ntz", [("FR", "2023-12-31 10:00:00"), ("FR", "2023-12-28 10:00:00"), (None, "2023-12-31 10:00:00"), ("FR", None)])
    ruled = holidays.holiday_calendar(spark, holidays.session_years(rows, 2))
    got = [r.holiday_period for r in enrich.holiday_flag(rows, ruled, "started_at", 2).orderBy("country", "started_at").collect()]
    assert sorted(got) == [0, 0, 0, 1]


# --- the thinned ROC curve ---------------------------------------------------------------------------

def test_points_on_a_line_are_left_out(spark):
    labels = [1, 1, 1, 0, 0, 1, 0, 1, 0, 0, 0]
    rows = [(y, 1 - k / 20) for k, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(4)
    full = sorted((r.threshold or 9, r.fpr, r.tpr) for r in evaluate.roc_curve(df, thin=False).collect())[::-1]
    thin = sorted((r.threshold or 9, r.fpr, r.tpr) for r in evaluate.roc_curve(df).collect())[::-1]
    steps = [(b[1] - a[1], b[2] - a[2]) for a, b in zip(full, full[1:])]
    inner = [full[k + 1] for k in range(1, len(steps) - 1) if (abs(steps[k][0] - steps[k + 1][0]) > 1e-9 or abs(steps[k][1] - steps[k + 1][1]) > 1e-9)]
    assert thin == [full[0], full[1], *inner, full[-1]] and len(thin) < len(full)

    def area(points):
        return sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))

    assert area(thin) == pytest.approx(area(full))
    assert evaluate.roc_curve(df.limit(0)).count() == 1
