"""Split, encodings, shifts, measures and feature selection on hand-made tables."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException

from plugtide.operators import evaluate, learn, prepare
from plugtide.config import Settings

ROWS = "session_date date, day_period string, evse_uid string, location_city string, y double"


def test_split_is_in_time_order(table):
    rows = [(f"2024-01-{d:02d}", "night", "a", "C", 0.0) for d in range(1, 8)] + [("2024-01-01", "night", "b", "C", 0.0)]
    out = prepare.sequential_split(table(ROWS, rows), "evse_uid", 0.8).collect()
    train = sorted(r["session_date"].day for r in out if r["is_train"] and r["evse_uid"] == "a")
    assert train == [1, 2, 3, 4, 5]  # floor(7 * 0.8)
    assert [r["is_train"] for r in out if r["evse_uid"] == "b"] == [False]


def test_target_encoding_of_seen_unseen_and_missing(table):
    df = table(f"{ROWS}, is_train boolean", [
        ("2024-01-01", "night", "a", "X", 1.0, True), ("2024-01-01", "night", "a", "X", 0.0, True),
        ("2024-01-01", "night", "a", None, 0.5, True), ("2024-01-02", "night", "a", "X", 9.0, False),
        ("2024-01-02", "night", "a", "new", 9.0, False), ("2024-01-02", "night", "a", None, 9.0, False),
    ])
    out = prepare.target_encode(df, ["location_city"], "y", 10.0)
    got = {(r["is_train"], r["location_city"]): r["location_city_encoded"] for r in out.collect()}
    assert got[True, "X"] == got[False, "X"] == pytest.approx((0.5 * 2 + 0.5 * 10) / 12)
    assert got[False, "new"] == got[False, None] == pytest.approx(0.5)
    assert got[True, None] is None


def test_unknown_category_fails(table):
    df = table("season string", [("Winter",), ("Monsoon",)])
    with pytest.raises(PySparkException, match="Monsoon"):
        prepare.ordinal_encode(df, {"season": ["Winter", "Spring"]}).collect()
    with pytest.raises(PySparkException, match="NULL"):
        prepare.label_encode(table("daily_period_busyness_cat string", [(None,)])).collect()


def test_shift_fills_first_rows(table):
    df = table(
        "session_date date, day_period string, evse_uid string, is_train boolean, holiday_period int, "
        "weekday_encoded int, daily_rolling_avg_1d double, daily_period_rolling_avg_1d double",
        [("2024-01-01", "night", "a", True, 0, 0, 1.0, 1.0), ("2024-01-02", "night", "a", True, 1, 1, 3.0, 2.0),
         ("2024-01-03", "night", "a", False, 1, 2, 5.0, 7.0)],
    )
    out = {r["session_date"].day: r for r in prepare.shift_features(df, "evse_uid").collect()}
    assert [out[d]["holiday_1d_shift"] for d in (1, 2, 3)] == [1, 0, 1]  # first rows wrap around
    assert [out[d]["weekday_enc_1d_shift"] for d in (1, 2, 3)] == [6, 0, 1]
    assert [out[d]["daily_busyness_2d_shift"] for d in (1, 2, 3)] == [2.0, 1.0, 5.0]


SCORED = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.4), (1, 0.4), (0, 0.1), (0, 0.1), (1, 0.05)]


def auc_by_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("transform", [lambda s: s, lambda s: math.exp(3 * s), lambda s: 0.5])
def test_auc_counts_pairs_and_ignores_scale(table, transform):
    rows = [(y, transform(s)) for y, s in SCORED]
    got = evaluate.roc_auc(table("label int, score double", rows)).first()["roc_auc"]
    assert got == pytest.approx(auc_by_pairs(rows))


def test_curves_and_threshold_against_brute_force(table):
    df = table("label int, score double", SCORED)
    points = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(df).collect()}
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df).collect()}
    assert points.pop(None) == (1.0, 0.0) and roc.pop(None) == (0.0, 0.0)
    best = (-1.0, 0.0)
    for t in {s for _, s in SCORED}:
        called = [y for y, s in SCORED if s >= t]
        p, r = sum(called) / len(called), sum(called) / 4
        assert points[t] == pytest.approx((p, r))
        assert roc[t] == pytest.approx(((len(called) - sum(called)) / 4, r))
        best = max(best, (2 * p * r / (p + r + 1e-10), -t))
    tuned = evaluate.tune_threshold(df).first()
    assert (tuned["optimal_f1"], tuned["optimal_threshold"]) == (pytest.approx(best[0]), -best[1])
    assert tuned["default_threshold"] == 0.4


def test_all_scores_equal(table):
    df = table("label int, score double", [(1, 0.3), (0, 0.3), (0, 0.3)])
    assert [tuple(r) for r in evaluate.pr_curve(df).collect()] == [(0.3, pytest.approx(1 / 3), 1.0), (None, 1.0, 0.0)]
    assert evaluate.roc_auc(df).first()[0] == 0.5


def test_measures_are_zero_where_undefined(table):
    df = table("label int, prediction int", [(1, 0), (0, 0)])
    assert evaluate.classification_metrics(df).first().asDict() == {
        "accuracy": 0.5, "precision": 0.0, "recall": 0.0, "f1": 0.0
    }
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


@pytest.mark.parametrize(
    "importances, kept",
    [([0.95, 0.03, 0.02], 1), ([0.5, 0.3, 0.15, 0.05], 2), ([1 / 20] * 20, 10), ([0.5, 0.4, 0.1], 2)],
)
def test_feature_selection(table, importances, kept):
    df = table("feature string, importance double", [(f"f{i:02d}", v) for i, v in enumerate(importances)])
    out = evaluate.select_features(df)
    assert sorted(r["rank"] for r in out.filter("selected").collect()) == list(range(1, kept + 1))


def test_class_weights(table):
    df = table("label int", [(0,)] * 7 + [(1,)] * 3)
    out = {r["label"]: r for r in learn.class_weights(df).collect()}
    assert out[0]["balanced"] == pytest.approx(10 / 14) and out[1]["balanced"] == pytest.approx(10 / 6)
    assert out[0]["positive"] == 1.0 and out[1]["positive"] == 2.33


def test_drawn_settings_are_repeatable_and_use_the_whole_range():
    settings = Settings()
    for name in learn.MODELS:
        drawn = learn.draw_settings(name, settings)
        assert drawn == learn.draw_settings(name, settings) and len(drawn) == 150
        for parameter, values in settings.search_spaces[name].items():
            own = [d[parameter] for d in drawn]
            if isinstance(values, list):
                assert set(own) == set(values)
            else:
                low, high = values
                assert low <= min(own) < low + 0.1 * (high - low) + 1 and high >= max(own) > high - 0.1 * (high - low) - 1
