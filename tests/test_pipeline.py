"""The whole pipeline on the given tables: against SQL, and one pass against single operators."""

from __future__ import annotations

import os
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from plugtide import config
from plugtide.functions.durable import durable, intermediate_tables
from plugtide.operators import evaluate, learn
from plugtide.plans import catalog, stages
from plugtide.plans.fixture import SETTINGS, Fixture
from plugtide.sources import tables

SF = "/root/testdata/sf0.001"
ENTRIES = catalog.entries()
# What many queries start from; written once for all of them here.
SHARED = ["cleaned", "enriched", "averaged", "timed_grid", "features", "matrix"]
FITTED = ["trained", "fixed_models"]


@pytest.fixture(scope="module", autouse=True)
def shared_stages():
    """Each shared table is worked out by its own code the first time and read from then on."""
    own = {name: getattr(catalog, name) for name in SHARED + FITTED}

    def once(name):
        kept = {}

        def stage(fx, *settings):
            key = repr(settings)
            if key not in kept:
                made = own[name](fx, *settings)
                kept[key] = durable(made, name) if name in SHARED else made
            return kept[key]

        return stage

    for name in own:
        setattr(catalog, name, once(name))
    yield
    for name, plain in own.items():
        setattr(catalog, name, plain)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("events", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_query_agrees_with_sql(spark, duck, name):
    df = ENTRIES[name].query(spark, SF)
    result = duck.execute(ENTRIES[name].oracle)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())


@pytest.fixture(scope="session")
def features(spark):
    return catalog.written_features(Fixture(spark, SF))


def test_one_pass_equals_single_operators(spark, features):
    fx = Fixture(spark, SF)
    steps = [
        *stages.cleaning_steps(fx.points, SETTINGS),
        *stages.feature_steps(fx.holidays, fx.population, SETTINGS),
        *stages.grid_steps(fx.holidays, SETTINGS),
        *stages.rolling_steps(SETTINGS),
    ]
    single = stages.compose(fx.sessions, steps, cut=True)
    assert sorted(single.columns) == sorted(features.columns)
    both = [catalog.shown(df, catalog.FEATURES) for df in (single, features)]
    assert both[0].exceptAll(both[1]).count() == both[1].exceptAll(both[0]).count() == 0


def test_grid_is_days_times_periods(features):
    per_point = features.groupBy("evse_uid").agg(
        F.count("*").alias("n"), (F.datediff(F.max("session_date"), F.min("session_date")) + 1).alias("days")
    )
    assert per_point.filter(F.col("n") != F.col("days") * len(config.DAY_PERIODS)).count() == 0


def test_checkpoint_is_computed_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.read_or_compute(spark, str(tmp_path / "t"), compute).count() == 3
    assert calls == [1]


def test_missing_input_columns_are_named(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1).write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="evse_uid"):
        tables.load_points(spark, path)


def test_an_interrupted_checkpoint_is_computed_again(spark, tmp_path):
    path = tmp_path / "t"
    whole = tables.read_or_compute(spark, str(path), lambda: spark.range(1000).repartition(4)).count()
    parts = sorted(path.glob("part-*"))
    for part in (path / "_SUCCESS", path / "._SUCCESS.crc", *parts[:2]):
        part.unlink()
    again = tables.read_or_compute(spark, str(path), lambda: spark.range(1000).repartition(4))
    assert whole == again.count() == 1000


def test_intermediate_tables_have_an_owner(spark, tmp_path):
    with intermediate_tables(spark):
        df = durable(spark.range(5), "owned")
        folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_unreadable_cells_are_named_or_missing(spark, tmp_path):
    path = str(tmp_path / "points")
    header = "evse_uid,started_at,stopped_at,last_energy_change_at,energy_wh,duration_seconds,location_name,location_city,country"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write(f"{header}\nP1,2024-01-01 10:00:00,,,12.5,soon,S,C,GB\n")
    with pytest.raises(Exception, match="Unreadable value in duration_seconds: soon"):
        tables.load_sessions(spark, path).collect()
    row = tables.load_sessions(spark, path, strict=False).first()
    assert row.duration_seconds is None and row.energy_wh == 12.5


def test_established_rule_leaves_stations_that_can_not_be_labelled(spark):
    established = replace(catalog.BY_STATION, compat=True)
    table = stages.model_table(catalog.written_features(Fixture(spark, SF), established), established)
    with pytest.raises(Exception, match="Unknown value in daily_period_busyness_cat: NULL"):
        table.collect()


def test_draws_differ_in_trees_and_depth():
    for settings in (config.Settings(), catalog.BY_POINT, catalog.BY_STATION):
        for name in learn.MODELS:
            drawn = learn.draw_settings(name, settings)
            assert len(drawn) == settings.search_iterations
            assert len({d["trees"] for d in drawn}) > 1 and len({d["depth"] for d in drawn}) > 1


def test_models_train_score_and_select(spark):
    """Thresholds tuned on the training rows, and everything that a training leaves behind."""
    settings = replace(catalog.BY_STATION, tune_on="train", search_iterations=1)
    matrix = catalog.matrix(Fixture(spark, SF), settings)
    trained = learn.train_models(matrix, settings, ["forest"])
    measures = {(run, metric): value for _, run, metric, value in trained[0].measures}
    assert 0.5 < measures["initial", "roc_auc"] <= 1.0
    assert 0 < measures["initial", "default_accuracy_train"] <= 1
    assert 1 <= measures["optimised", "features"] <= 10
    tuned = evaluate.tune_threshold(trained[0].scored["initial"].filter("is_train")).first()
    assert measures["initial", "optimal_threshold"] == tuned["optimal_threshold"]
    results = learn.result_tables(spark, trained)
    assert {"measures", "hyper_parameters", "search", "importances", "confusion_matrix", "roc_curve"} <= set(results)
    assert results["importances"].filter("selected").count() == measures["optimised", "features"]
    assert results["confusion_matrix"].groupBy("run", "threshold_kind").count().count() == 4


def test_weights_of_a_fit_come_from_its_own_rows(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 20, 1.0).otherwise(0.0).alias("label"), "id")
    some = learn.weighted(rows.filter("id < 60"), "balanced")
    assert {(r.label, round(r.weight, 6)) for r in some.collect()} == {(1.0, 1.5), (0.0, 0.75)}


def test_folds_are_even_within_labels(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    counts = learn.with_folds(rows, ["k"], 3).groupBy("label", "fold").count().collect()
    for label, size in ((0, 3600), (1, 400)):
        own = [r["count"] for r in counts if r["label"] == label]
        assert len(own) == 3 and max(own) - min(own) < 0.25 * size / 3
