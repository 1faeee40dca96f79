"""The registered queries: every operator on the fixture views, with its reference SQL.

A query of an operator runs the plan that leads to it and shows the rows it leaves. Columns are
shown the same way on both sides (`oracles.rendered`): dates and times as text, doubles to six places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugtide import config
from plugtide.functions.durable import durable, fresh_path
from plugtide.operators import enrich, evaluate, expand, filters, grid, holidays, learn, overlaps, prepare, repair, rolling
from plugtide.operators.rollup import station_rollup
from plugtide.operators.trees import Model, Plan, tree_table
from plugtide.plans import oracles, stages, tree_sql
from plugtide.plans.fixture import SETTINGS, Fixture
from plugtide.sources import tables

REPAIRED = replace(SETTINGS, compat=False)
# Small enough for SQL to fit every draw again, and wide enough that draws differ in trees and in depth.
SEARCH = {
    "search_iterations": 3,
    "folds": 2,
    "fit_parallelism": 4,
    "search_spaces": {
        "forest": config.FOREST_SPACE | {"trees": (2, 4), "depth": (2, 5)},
        "boosted_deep": config.DEEP_BOOST_SPACE | {"trees": (2, 4), "depth": (2, 6)},
        "boosted_leaf": config.LEAF_BOOST_SPACE | {"trees": (2, 4), "depth": (2, 6), "min_leaf": (2, 20), "leaves": (3, 9)},
    },
}
# The wider search that the bench times.
WIDE_SEARCH = SEARCH | {
    "search_spaces": {
        "forest": config.FOREST_SPACE | {"trees": (4, 12), "depth": (3, 7)},
        "boosted_deep": config.DEEP_BOOST_SPACE | {"trees": (3, 9), "depth": (2, 5)},
        "boosted_leaf": config.LEAF_BOOST_SPACE | {"trees": (3, 9), "depth": (2, 5), "min_leaf": (2, 20)},
    },
}
# Plans small enough for SQL to fit them again, with every bound and weight in force.
FIXED = {
    "forest": {"trees": 4, "depth": 5, "min_leaf": 3, "min_split": 12, "feature_subset": "sqrt", "impurity": "gini"},
    "boosted_deep": {
        "trees": 3, "depth": 4, "learning_rate": 0.2, "row_share": 0.8, "feature_share": 0.7, "min_gain": 0.3, "l1": 0.5, "l2": 1.5,
    },
    "boosted_leaf": {
        "trees": 3, "depth": 6, "leaves": 9, "min_leaf": 20, "learning_rate": 0.2, "row_share": 0.9, "feature_share": 0.8,
    },
}
BY_POINT = replace(SETTINGS, grain="points", **SEARCH)
# The whole search: 150 draws of up to 2,500 trees on three folds.
WHOLE = replace(SETTINGS, grain="points")
# The queries that make it. SQL can follow it, but neither side ends within hours: tests compare a smaller one.
WHOLE_QUERIES = ("train_models", "score", "model_results")
# Stations are labelled by the repaired rule: the established one leaves mean busyness of 1.01 and
# more without a category, and such rows can not be labelled.
BY_STATION = replace(SETTINGS, compat=False, **SEARCH)

RAW = [
    "evse_uid", "started_at", "stopped_at", "last_energy_change_at", "energy_wh", "duration_seconds",
    "location_name", "location_city", "country",
]
TYPED = [*RAW, "type"]
RANGED = [*TYPED, "first_active_day", "final_active_day", "last_session_pre_data"]
PERIOD_KEYS = ["session_date", "day_period", "evse_uid"]
AGGREGATED = [
    *PERIOD_KEYS, "usage_time", "type", "first_active_day", "final_active_day", "last_session_pre_data",
    "period_duration", "month", "country", "weekday", "season", "year", "location_city", "location_name",
    "holiday_period", "city_type", "station_charging_points", "station_avg_power", "point_avg_power",
    "avg_total_busyness", "avg_day_period_busyness",
]
SINCE = ["days_since_data_start", "weeks_since_data_start", "days_since_point_active", "weeks_since_point_active"]
GRID = [
    *AGGREGATED, "started_at", "quarter", "gap_days", "daily_period_busyness", "daily_period_busyness_cat", *SINCE,
]
ROLLED = [
    "session_date", "day_period", "location_name", "first_active_day", "gap_days", "usage_time",
    *config.STATION_FIRSTS, *config.STATION_MEANS, "daily_period_busyness_cat",
]


def shown(df: DataFrame, columns: list[str]) -> DataFrame:
    def rendered(name: str) -> Column:
        kind, column = oracles.kind_of(name), F.col(name)
        return {
            "s": lambda: column,
            "d": lambda: F.date_format(column, "yyyy-MM-dd"),
            "t": lambda: F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "i": lambda: column.cast("bigint"),
            "f": lambda: F.round(column.cast("double") + F.lit(oracles.NUDGE), 6) + F.lit(0.0),
        }[kind]().alias(name)

    return df.select(*map(rendered, columns))


@dataclass(frozen=True)
class Entry:
    run: Callable[[Fixture], DataFrame]
    columns: list[str] | None = None
    sql: str | None = None
    extra: dict[str, str] | Callable[[], dict[str, str]] | None = None
    # SQL like `sql`, of a query that does not end in the time of a test.
    whole: str | None = None

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(Fixture(spark, sf_dir))
        return shown(df, self.columns) if self.columns else df

    @property
    def oracle(self) -> str | None:
        sql, extra = self.sql or self.whole, self.extra
        return oracles.statement(sql, self.columns, extra() if callable(extra) else extra) if sql else None


# --- inputs of the operators ----------------------------------------------------------------------

S = {"settings": SETTINGS}


def typed(fx: Fixture) -> DataFrame:
    return enrich.merge_type(fx.sessions, fx.points)


def first_repairs(fx: Fixture, count: int) -> DataFrame:
    steps = [
        repair.drop_copies, repair.fix_end_before_start, repair.infer_stop, repair.fill_energy_end,
        repair.correct_duration, (filters.drop_old, S),
    ]
    return stages.compose(typed(fx), steps[:count])


def ranged(fx: Fixture, count: int) -> DataFrame:
    """The session filters up to a number of steps after the range."""
    steps = [
        (filters.desired_range, S), (filters.drop_short, S), filters.drop_no_energy, (filters.drop_long, S),
        (filters.active_life_filter, S), (filters.charger_type, S), (filters.min_sessions, S),
        overlaps.fix_overlaps,
    ]
    start = first_repairs(fx, 6)
    return stages.compose(start, steps[: count + 1])


def cleaned(fx: Fixture) -> DataFrame:
    return stages.clean(fx.sessions, fx.points, SETTINGS)


def energised(fx: Fixture) -> DataFrame:
    return stages.compose(cleaned(fx), [enrich.energy_kwh, enrich.charging_time])


def dated(fx: Fixture) -> DataFrame:
    """Energised sessions with calendar columns."""
    return stages.compose(
        energised(fx), [(enrich.time_features, {"date_col": "started_at"}), enrich.session_dates]
    )


def enriched(fx: Fixture) -> DataFrame:
    """All session-level features; written, since the station and point figures read it again."""
    steps = stages.feature_steps(fx.holidays, fx.population, SETTINGS)[:10]
    rows = durable(energised(fx), "energised")
    return durable(stages.compose(rows, steps[2:]), "enriched")


def allocated(fx: Fixture) -> DataFrame:
    return stages.compose(enriched(fx), [expand.split_days, expand.period_allocation])


def averaged(fx: Fixture) -> DataFrame:
    return expand.average_busyness(durable(allocated(fx), "allocated"))


def aggregated(fx: Fixture) -> DataFrame:
    return grid.aggregate_by_point(averaged(fx))


def grid_of(fx: Fixture, settings=SETTINGS) -> DataFrame:
    agg = grid.period_busyness(aggregated(fx), settings)
    return durable(grid.fill_grid(agg, fx.holidays, settings), "grid")


def timed_grid(fx: Fixture) -> DataFrame:
    """The grid through the one-pass plan."""
    days = durable(stages.day_table(fx.sessions, fx.points, fx.population, SETTINGS), "days")
    return stages.grid_from_days(days, fx.holidays, SETTINGS)


def features(fx: Fixture, settings=SETTINGS) -> DataFrame:
    return stages.point_features(fx.sessions, fx.points, fx.holidays, fx.population, settings)


def written_features(fx: Fixture, settings=SETTINGS) -> DataFrame:
    return durable(features(fx, settings), "features")


def split_points(fx: Fixture) -> DataFrame:
    return stages.split(features(fx), replace(SETTINGS, grain="points"))


def ordinals(fx: Fixture) -> DataFrame:
    return prepare.ordinal_encode(split_points(fx))


def matrix(fx: Fixture, settings=BY_POINT) -> DataFrame:
    return durable(stages.model_table(features(fx, settings), settings), "matrix")


def predicted(fx: Fixture) -> DataFrame:
    return evaluate.apply_threshold(fx.scores, 0.5)


MEASURED = [c for c in config.POINT_FEATURES if not c.endswith("_encoded") and c not in (*config.PRODUCTS, *config.DIFFERENCES)]


def correlations(fx: Fixture) -> DataFrame:
    """A stand-in for a model's importances that SQL can follow: |correlation| with the busyness."""
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.round(F.abs(F.coalesce(F.nanvl(F.corr(c, "daily_period_busyness"), F.lit(0.0)), F.lit(0.0))), 6).alias("importance"),
        )
        for c in MEASURED
    ])
    return features(fx).agg(rows.alias("_r")).select(F.inline("_r"))


IMPORTANCES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, daily_period_busyness) ELSE 0 END), 6) "
    f"AS importance FROM features" for c in MEASURED
)


# --- sources: written to a fresh folder and read back ----------------------------------------------

def load_sessions(fx: Fixture) -> DataFrame:
    path = fresh_path(fx.spark, "sessions-csv")
    fx.sessions.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return tables.load_sessions(fx.spark, path)


def load_points(fx: Fixture) -> DataFrame:
    path = fresh_path(fx.spark, "points-csv")
    wide = fx.points.select(F.lit("fast").alias("model"), "type", "evse_uid")
    wide.write.option("header", True).csv(path)
    return tables.load_points(fx.spark, path)


def checkpoint_roundtrip(fx: Fixture) -> DataFrame:
    """Computed and written on the first call, read on the second."""
    path = fresh_path(fx.spark, "checkpoint")
    for _ in range(2):
        df = tables.read_or_compute(fx.spark, path, lambda: features(fx))
    return df


def checkpoint_refresh(fx: Fixture) -> DataFrame:
    """Written without the late sessions of one point in twenty, then refreshed with all sessions."""
    path = fresh_path(fx.spark, "features")
    late = F.col("evse_uid").substr(-2, 2).isin("03", "23", "43", "63", "83") & (F.col("started_at") >= "2024-01-20")
    for sessions in (fx.sessions.filter(~late), fx.sessions):
        df = stages.refreshed_features(path, sessions, fx.points, fx.holidays, fx.population, REPAIRED)
    return df


def calendar_by_rules(fx: Fixture) -> DataFrame:
    """Holidays of all countries with rules, in the years of the sessions."""
    return holidays.holiday_calendar(fx.spark, holidays.session_years(fx.sessions, SETTINGS.holiday_radius_days))


def holiday_flag_by_rules(fx: Fixture) -> DataFrame:
    return enrich.holiday_flag(dated(fx), calendar_by_rules(fx), "started_at", SETTINGS.holiday_radius_days)


# --- models ----------------------------------------------------------------------------------------

def trained(fx: Fixture, settings) -> tuple[DataFrame, list[learn.Trained]]:
    """The matrix, and all models searched and fitted on it."""
    table = matrix(fx, settings)
    return table, learn.train_models(table, settings)


def fixed_plans(settings, rows: int = 2, positives: int = 1) -> list[Plan]:
    everything = list(range(len(settings.features)))
    return [learn.plan(name, drawn, settings, everything, rows, positives) for name, drawn in FIXED.items()]


def fixed_models(fx: Fixture, settings) -> tuple[learn.Matrix, list[Model]]:
    ready = learn.binned(matrix(fx, settings), settings)
    return ready, learn.fit(ready, fixed_plans(settings, *ready.fitted_on(learn.WHOLE)))


def fitted_trees(fx: Fixture, settings) -> DataFrame:
    """Every node of three small models: splits with their gains, leaves with their values."""
    return tree_table(fx.spark, fixed_models(fx, settings)[1])


def fitted_scores(fx: Fixture, settings) -> DataFrame:
    """The test rows as these models score them."""
    ready, models = fixed_models(fx, settings)
    return _by_model([(m.plan.name, learn.score(m, ready).filter("NOT is_train")) for m in models])


def split_importances(fx: Fixture, settings) -> DataFrame:
    """Importances of these models, walked from their trees."""
    return _by_model([(m.plan.name, learn.importances(fx.spark, m)) for m in fixed_models(fx, settings)[1]])


def _by_model(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    shown = [df.withColumn("model", F.lit(name)) for name, df in parts]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


def train_models(fx: Fixture, settings) -> DataFrame:
    """Every node of the best model of each kind, fitted on all training rows."""
    return tree_table(fx.spark, [t.model for t in trained(fx, settings)[1]])


def random_search(fx: Fixture, settings) -> DataFrame:
    """Every draw on every fold."""
    return learn.result_tables(fx.spark, trained(fx, settings)[1])["search"]


def score(fx: Fixture, settings) -> DataFrame:
    """The test rows as the best setting of each model scores them."""
    return _by_model([(t.name, t.scored["initial"].filter("NOT is_train")) for t in trained(fx, settings)[1]])


def retrain_selected(fx: Fixture, settings) -> DataFrame:
    """Every node of the models fitted again on their selected features."""
    return tree_table(fx.spark, [t.retrained for t in trained(fx, settings)[1]])


def model_results(fx: Fixture, settings) -> DataFrame:
    """Every measure as the result store gives it back."""
    results, folder = learn.result_tables(fx.spark, trained(fx, settings)[1]), fresh_path(fx.spark, "results")
    tables.write_results(results, folder)
    return tables.read_results(fx.spark, folder, list(results))["measures"]


def evaluation_tables(fx: Fixture) -> DataFrame:
    """All evaluation tables of the fixture's scores, written, read back and shown as one."""
    optimal = evaluate.tune_threshold(fx.scores).first()["optimal_threshold"]
    results = evaluate.evaluation_tables(predicted(fx), durable(evaluate.by_score(fx.scores), "points"), optimal)
    folder = fresh_path(fx.spark, "results")
    tables.write_results(results, folder)
    read = tables.read_results(fx.spark, folder, list(results))

    def rows(part: str, kind: str, name: Column, threshold: str, *values: str) -> DataFrame:
        numbers = dict(zip("xyz", [F.col(v).cast("double") for v in values] + [F.lit(None).cast("double")] * 3))
        return read[part].select(
            F.lit(part).alias("part"), F.expr(kind).cast("string").alias("threshold_kind"), name.cast("string").alias("name"),
            F.expr(threshold).cast("double").alias("threshold"), *[c.alias(n) for n, c in numbers.items()],
        )

    none = F.lit(None)
    cell = F.concat_ws("-", F.col("actual").cast("string"), F.col("predicted").cast("string"))
    return (
        rows("confusion_matrix", "threshold_kind", cell, "NULL", "rows")
        .unionByName(rows("classification_report", "threshold_kind", F.col("class"), "NULL", "precision", "recall", "f1"))
        .unionByName(rows("roc_curve", "NULL", none, "threshold", "fpr", "tpr"))
        .unionByName(rows("pr_curve", "NULL", none, "threshold", "precision", "recall"))
        .unionByName(rows("f1_by_threshold", "NULL", none, "threshold", "precision", "recall", "f1"))
    )


def class_weights(settings, tag: str) -> Entry:
    return Entry(
        lambda fx: learn.class_weights(matrix(fx, settings).filter("is_train")),
        ["label", "rows", "balanced", "positive"],
        f"""
SELECT label, rows, sum(rows) OVER () / (2.0 * rows) AS balanced,
       CASE WHEN label = 1 THEN round(sum(rows) FILTER (WHERE label = 0) OVER () / CAST(rows AS DOUBLE), 2) ELSE 1 END AS positive
FROM (SELECT label, count(*) AS rows FROM crossed{tag} WHERE is_train = 1 GROUP BY label)""",
    )


def fixed_entries(settings, tag: str, suffix: str) -> dict[str, Entry]:
    """The queries on the fixed plans; SQL fits them again."""
    features = settings.features
    extra = tree_sql.matrix(tag, settings.group, features, settings.folds)
    extra |= tree_sql.fitted(f"{tag}_x", tag, fixed_plans(settings), list(FIXED.values()))
    names = f"([{', '.join(repr(f) for f in features)}])[f + 1]"
    x = f"{tag}_x"
    keys = ["session_date", "day_period", settings.group]

    def entry(function, columns: list[str], sql: str) -> Entry:
        return Entry(lambda fx: function(fx, settings), columns, sql, extra)

    return {
        f"fitted_trees{suffix}": entry(
            fitted_trees, ["model", "tree", "node", "feature", "threshold", "gain", "rows", "value"],
            f"SELECT *, {names} AS feature FROM nodes{x}",
        ),
        f"fitted_scores{suffix}": entry(
            fitted_scores, ["model", *keys, "label", "score", "prediction"],
            f"SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scores{x} "
            f"JOIN mx{tag} USING (rid) JOIN plans{x} USING (job) WHERE is_train = 0",
        ),
        f"split_importances{suffix}": entry(
            split_importances, ["model", "feature", "importance", "total_gain", "splits"],
            f"""
SELECT model, ([{', '.join(repr(f) for f in features)}])[f + 1] AS feature, coalesce(total_gain, 0) AS total_gain, coalesce(splits, 0) AS splits,
       CASE WHEN forest = 1 THEN coalesce(shares, 0) WHEN leaves > 0 THEN coalesce(splits, 0) ELSE coalesce(total_gain / splits, 0) END AS importance
FROM plans{x} CROSS JOIN (SELECT unnest(range(0, {len(features)})) AS f) LEFT JOIN (
  SELECT model, f, sum(gain) AS total_gain, count(*) AS splits, sum(share / trees) AS shares
  FROM (SELECT *, gain / sum(gain) OVER (PARTITION BY model, tree) AS share FROM nodes{x} WHERE f IS NOT NULL)
  JOIN (SELECT model, trees FROM plans{x}) USING (model) GROUP BY model, f) USING (model, f)""",
        ),
    }


def search_tables(settings, tag: str, fit: Callable[..., dict[str, str]]) -> dict[str, str]:
    """SQL that searches, fits, selects and fits again."""
    features = settings.features
    drawn = {name: learn.draw_settings(name, settings) for name in learn.MODELS}
    jobs = [
        (learn.plan(name, d, settings, list(range(len(features))), 2, 1, draw=number, held_out=fold), d)
        for name, draws in drawn.items() for number, d in enumerate(draws) for fold in (*range(settings.folds), learn.WHOLE)
    ]
    extra = tree_sql.matrix(tag, settings.group, features, settings.folds)
    extra |= tree_sql.search(tag, features, settings.importance_share, settings.max_features, *map(list, zip(*jobs)), fit)
    return extra | tree_sql.results(tag, len(features))


def model_entries(settings, tag: str, suffix: str, whole: bool = False) -> dict[str, Entry]:
    """The queries on searched models at one grain; a `whole` search has SQL of any number of trees, made when asked for."""
    keys, features = ["session_date", "day_period", settings.group], settings.features
    extra = (lambda: search_tables(settings, tag, tree_sql.regrown)) if whole else search_tables(settings, tag, tree_sql.fitted)
    names = f"([{', '.join(repr(f) for f in features)}])[f + 1]"
    nodes = ["model", "tree", "node", "feature", "threshold", "gain", "rows", "value"]

    def entry(function, columns: list[str], sql: str) -> Entry:
        return Entry(lambda fx: function(fx, settings), columns, None if whole else sql, extra, sql if whole else None)

    return {
        f"train_models{suffix}": entry(train_models, nodes, f"SELECT *, {names} AS feature FROM first_nodes{tag}"),
        f"random_search{suffix}": entry(
            random_search, ["model", "draw", "fold", "rows", "positives", "tp", "fp", "fn", "tn", "f1", "best"],
            f"SELECT t.*, CASE WHEN b.draw IS NULL THEN 0 ELSE 1 END AS best FROM tried{tag} t LEFT JOIN best{tag} b USING (model, draw)",
        ),
        f"score{suffix}": entry(
            score, ["model", *keys, "label", "score", "prediction"],
            f"SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM judged{tag} JOIN "
            f"(SELECT * EXCLUDE (label, is_train) FROM mx{tag}) USING (rid) WHERE is_train = 0 AND run = 'initial'",
        ),
        f"retrain_selected{suffix}": entry(retrain_selected, nodes, f"SELECT *, {names} AS feature FROM nodes{tag}_r"),
        f"model_results{suffix}": entry(model_results, ["model", "run", "metric", "value"], f"SELECT * FROM results{tag}"),
    }


# --- the catalog -----------------------------------------------------------------------------------

FEATURES = [*GRID, *[c for c in config.STATION_MEANS if c not in GRID]]
KW = ["evse_uid", "started_at", "location_name", "energy_kwh", "session_charging_duration"]


def _rolling(function, new: list[str], table: str, **arguments) -> Entry:
    def run(fx: Fixture) -> DataFrame:
        df = timed_grid(fx)
        if function is rolling.cumulative_daily:
            df = rolling.rolling_daily(df)
        return function(df, **arguments)

    columns = [*PERIOD_KEYS, *new]
    return Entry(run, columns, f"SELECT * FROM {table}")


def entries() -> dict[str, Entry]:
    return {
        # sources
        "load_sessions": Entry(load_sessions, RAW, "SELECT * FROM sessions"),
        "load_points": Entry(load_points, ["evse_uid", "type"], "SELECT * FROM charge_points"),
        "checkpoint_roundtrip": Entry(checkpoint_roundtrip, FEATURES, "SELECT * FROM features"),
        "checkpoint_refresh": Entry(checkpoint_refresh, FEATURES, "SELECT * FROM features_repaired"),
        # cleaning
        "merge_type": Entry(typed, TYPED, "SELECT * FROM typed"),
        "dedup_sessions": Entry(lambda fx: first_repairs(fx, 1), TYPED, "SELECT * FROM c1"),
        "fix_end_before_start": Entry(lambda fx: first_repairs(fx, 2), TYPED, "SELECT * FROM c2"),
        "infer_stop": Entry(lambda fx: first_repairs(fx, 3), TYPED, "SELECT * FROM c3"),
        "fill_energy_end": Entry(lambda fx: first_repairs(fx, 4), TYPED, "SELECT * FROM c4"),
        "correct_duration": Entry(lambda fx: first_repairs(fx, 5), TYPED, "SELECT * FROM c5"),
        "drop_old": Entry(lambda fx: first_repairs(fx, 6), TYPED, "SELECT * FROM c6"),
        "desired_range": Entry(lambda fx: ranged(fx, 0), RANGED, "SELECT * FROM c7"),
        "drop_short": Entry(lambda fx: ranged(fx, 1), RANGED, "SELECT * FROM c8"),
        "drop_no_energy": Entry(lambda fx: ranged(fx, 2), RANGED, "SELECT * FROM c9"),
        "drop_long": Entry(lambda fx: ranged(fx, 3), RANGED, "SELECT * FROM c10"),
        "active_life_filter": Entry(lambda fx: ranged(fx, 4), RANGED, "SELECT * FROM c11"),
        "charger_type": Entry(lambda fx: ranged(fx, 5), RANGED, "SELECT * FROM c12"),
        "min_sessions": Entry(lambda fx: ranged(fx, 6), RANGED, "SELECT * FROM c13"),
        "fix_overlaps": Entry(lambda fx: ranged(fx, 7), RANGED, "SELECT * FROM c14"),
        "clean_sessions": Entry(cleaned, RANGED, "SELECT * FROM c14"),
        # session features
        "energy_kwh": Entry(
            lambda fx: enrich.energy_kwh(cleaned(fx)), [*RANGED, "energy_kwh"], "SELECT * FROM f2"
        ),
        "charging_time": Entry(
            lambda fx: enrich.charging_time(cleaned(fx)), [*RANGED, "session_charging_duration"], "SELECT * FROM f2"
        ),
        "station_avg_power": Entry(
            lambda fx: enrich.station_avg_power(energised(fx)), [*KW, "station_avg_power"], "SELECT * FROM f5"
        ),
        "point_avg_power": Entry(
            lambda fx: enrich.point_avg_power(energised(fx)), [*KW, "point_avg_power"], "SELECT * FROM f5"
        ),
        "station_points": Entry(
            lambda fx: enrich.station_points(energised(fx)), [*KW, "station_charging_points"], "SELECT * FROM f5"
        ),
        "time_features": Entry(
            lambda fx: enrich.time_features(cleaned(fx), "started_at"),
            [*RANGED, "weekday", "month", "quarter", "season", "year"], "SELECT * FROM f7",
        ),
        "session_dates": Entry(
            lambda fx: enrich.session_dates(cleaned(fx)), [*RANGED, "session_date", "end_date"], "SELECT * FROM f7"
        ),
        "holiday_flag": Entry(
            lambda fx: enrich.holiday_flag(dated(fx), fx.holidays, "started_at", SETTINGS.holiday_radius_days),
            [*RANGED, "holiday_period"], "SELECT * FROM f8",
        ),
        "holiday_calendar": Entry(
            calendar_by_rules, ["country", "holiday_date"], "SELECT * FROM ruled_days", oracles.RULED_DAYS
        ),
        "holiday_flag_by_rules": Entry(
            holiday_flag_by_rules, [*RANGED, "holiday_period"],
            f"""
SELECT f7.*, CASE WHEN EXISTS (SELECT 1 FROM ruled_days h WHERE h.country = f7.country
  AND abs(date_diff('day', h.holiday_date, CAST(f7.started_at AS DATE))) <= {SETTINGS.holiday_radius_days}) THEN 1 ELSE 0 END AS holiday_period
FROM f7""",
            oracles.RULED_DAYS,
        ),
        "population_join": Entry(
            lambda fx: enrich.population_join(cleaned(fx), fx.population), [*RANGED, "population"], "SELECT * FROM f9"
        ),
        "city_type": Entry(
            lambda fx: enrich.city_type(enrich.population_join(cleaned(fx), fx.population)),
            [*RANGED, "population", "city_type"], "SELECT * FROM f10",
        ),
        "split_days": Entry(
            lambda fx: expand.split_days(dated(fx)),
            [*RANGED, "energy_kwh", "session_charging_duration", "weekday", "month", "session_date", "end_date",
             "session_duration"],
            "SELECT * FROM f11",
        ),
        "period_allocation": Entry(
            lambda fx: expand.period_allocation(expand.split_days(dated(fx))),
            [*PERIOD_KEYS, "started_at", "stopped_at", "period_duration", "usage_time"], "SELECT * FROM f12",
        ),
        "average_busyness": Entry(
            averaged, [*PERIOD_KEYS, "started_at", "usage_time", "avg_total_busyness", "avg_day_period_busyness"],
            "SELECT * FROM f13",
        ),
        # grid
        "aggregate_by_point": Entry(aggregated, AGGREGATED, "SELECT * FROM agg"),
        "operation_time": Entry(
            lambda fx: grid.operation_time(durable(aggregated(fx), "aggregated")), [*AGGREGATED, *SINCE],
            "SELECT * FROM operated",
        ),
        "period_busyness": Entry(
            lambda fx: grid.period_busyness(aggregated(fx), SETTINGS),
            [*AGGREGATED, "daily_period_busyness", "daily_period_busyness_cat"], "SELECT * FROM busy",
        ),
        "period_busyness_repaired": Entry(
            lambda fx: grid.period_busyness(aggregated(fx), REPAIRED),
            [*AGGREGATED, "daily_period_busyness", "daily_period_busyness_cat"], "SELECT * FROM busy_repaired",
        ),
        "fill_grid": Entry(
            lambda fx: grid.operation_time(grid_of(fx)), GRID, "SELECT * FROM grid"
        ),
        "fill_grid_repaired": Entry(
            lambda fx: grid.operation_time(grid_of(fx, REPAIRED)), GRID, "SELECT * FROM grid_repaired"
        ),
        "gap_days": Entry(
            lambda fx: grid.gap_days(timed_grid(fx)), [*PERIOD_KEYS, "usage_time", "gap_days"], "SELECT * FROM grid"
        ),
        "grid_from_days": Entry(timed_grid, GRID, "SELECT * FROM grid"),
        # rolling
        "rolling_daily": _rolling(
            rolling.rolling_daily,
            ["daily_busyness", "daily_rolling_avg_1d", "daily_rolling_avg_7d", "daily_rolling_avg_30d"], "features",
        ),
        "rolling_period": _rolling(
            rolling.rolling_period,
            ["daily_period_rolling_avg_1d", "daily_period_rolling_avg_7d", "daily_period_rolling_avg_30d"], "features",
        ),
        "rolling_iqr": _rolling(
            rolling.rolling_iqr, ["daily_period_rolling_IQR_7d", "daily_period_rolling_IQR_30d"], "features",
            settings=SETTINGS,
        ),
        "rolling_iqr_repaired": _rolling(
            rolling.rolling_iqr, ["daily_period_rolling_IQR_7d", "daily_period_rolling_IQR_30d"], "r7_plain",
            settings=REPAIRED,
        ),
        "past_week": _rolling(rolling.past_week, ["past_week_same_period"], "features"),
        "cumulative_daily": _rolling(
            rolling.cumulative_daily, ["weekly_cumulative_average", "daily_cumulative_average"], "features"
        ),
        "cumulative_period": _rolling(
            rolling.cumulative_period, ["period_weekly_cumulative_average", "period_daily_cumulative_average"],
            "features",
        ),
        "point_features": Entry(features, FEATURES, "SELECT * FROM features"),
        "point_features_repaired": Entry(
            lambda fx: features(fx, REPAIRED), FEATURES, "SELECT * FROM features_repaired"
        ),
        # stations, train and test
        "station_rollup": Entry(
            lambda fx: station_rollup(features(fx), SETTINGS), ROLLED, "SELECT * FROM rolled"
        ),
        "sequential_split": Entry(split_points, [*PERIOD_KEYS, "is_train"], "SELECT * FROM split_points"),
        "sequential_split_stations": Entry(
            lambda fx: prepare.sequential_split(station_rollup(features(fx), SETTINGS), "location_name"),
            ["session_date", "day_period", "location_name", "is_train"], "SELECT * FROM split_stations",
        ),
        "target_encode": Entry(
            lambda fx: prepare.target_encode(
                split_points(fx), ["location_city", "evse_uid"], "daily_period_busyness", SETTINGS.alpha
            ),
            [*PERIOD_KEYS, "is_train", "location_city_encoded", "evse_uid_encoded"], "SELECT * FROM targets_points",
        ),
        "ordinal_encode": Entry(
            ordinals, [*PERIOD_KEYS, *[f"{c}_encoded" for c in config.ORDINAL_ORDERS]],
            "SELECT * FROM ordinals_points",
        ),
        "label_encode": Entry(
            lambda fx: prepare.label_encode(written_features(fx)),
            [*PERIOD_KEYS, "daily_period_busyness_cat", "label"], "SELECT * FROM crossed_points",
        ),
        "shift_features": Entry(
            lambda fx: prepare.shift_features(ordinals(fx), "evse_uid"), [*PERIOD_KEYS, "is_train", *config.SHIFTED],
            "SELECT * FROM shifts_points",
        ),
        "interaction_product": Entry(
            lambda fx: prepare.interaction_product(
                ordinals(fx), "weekday_x_day_period", "weekday_encoded", "day_period_encoded"
            ),
            [*PERIOD_KEYS, "weekday_x_day_period"], "SELECT * FROM crossed_points",
        ),
        "interaction_difference": Entry(
            lambda fx: prepare.interaction_difference(
                prepare.shift_features(ordinals(fx), "evse_uid"), "busyness_change", "daily_rolling_avg_1d",
                "daily_busyness_2d_shift",
            ),
            [*PERIOD_KEYS, "busyness_change"], "SELECT * FROM crossed_points",
        ),
        "interactions": Entry(
            lambda fx: prepare.interactions(ordinals(fx), "evse_uid"),
            [*PERIOD_KEYS, "is_train", *config.PRODUCTS, *config.DIFFERENCES], "SELECT * FROM crossed_points",
        ),
        "interactions_stations": Entry(
            lambda fx: prepare.interactions(
                stages.preprocess(stages.split(station_rollup(features(fx), SETTINGS), SETTINGS), SETTINGS), "location_name"
            ),
            ["session_date", "day_period", "location_name", "is_train", "location_city_encoded", "location_name_encoded",
             *config.STATION_FEATURES],
            "SELECT * FROM crossed_stations",
        ),
        "training_matrix": Entry(
            matrix, [*PERIOD_KEYS, *config.POINT_FEATURES, "label", "is_train"], "SELECT * FROM crossed_points"
        ),
        "class_weights": class_weights(BY_POINT, "_points"),
        "label_encode_stations": Entry(
            lambda fx: prepare.label_encode(station_rollup(features(fx, REPAIRED), REPAIRED)),
            ["session_date", "day_period", "location_name", "daily_period_busyness_cat", "label"],
            "SELECT * FROM crossed_stations_repaired",
        ),
        "training_matrix_stations": Entry(
            lambda fx: matrix(fx, BY_STATION),
            ["session_date", "day_period", "location_name", *config.STATION_FEATURES, "label", "is_train"],
            "SELECT * FROM crossed_stations_repaired",
        ),
        "class_weights_stations": class_weights(BY_STATION, "_stations_repaired"),
        # models
        **fixed_entries(BY_POINT, "_points", ""),
        **fixed_entries(BY_STATION, "_stations_repaired", "_stations"),
        **model_entries(BY_POINT, "_points", ""),
        **{name: e for name, e in model_entries(WHOLE, "_points", "", whole=True).items() if name in WHOLE_QUERIES},
        **model_entries(BY_STATION, "_stations_repaired", "_stations"),
        "evaluation_tables": Entry(
            evaluation_tables, ["part", "threshold_kind", "name", "threshold", "x", "y", "z"], oracles.EVALUATION,
            {"report": oracles.REPORT},
        ),
        # measures
        "confusion_matrix": Entry(
            lambda fx: evaluate.confusion_matrix(predicted(fx)), ["actual", "predicted", "rows"],
            "SELECT 0 AS actual, 0 AS predicted, tn AS rows FROM counts UNION ALL SELECT 0, 1, fp FROM counts "
            "UNION ALL SELECT 1, 0, fn FROM counts UNION ALL SELECT 1, 1, tp FROM counts",
        ),
        "classification_metrics": Entry(
            lambda fx: evaluate.classification_metrics(predicted(fx)), ["accuracy", "precision", "recall", "f1"],
            oracles.MEASURES.format(counts="counts"),
        ),
        "classification_report": Entry(
            lambda fx: evaluate.classification_report(predicted(fx)),
            ["class", "precision", "recall", "f1", "support"],
            """
SELECT * FROM report
UNION ALL SELECT 'accuracy', (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE),
       (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), tp + tn + fp + fn FROM counts
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM report
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1 * support) / sum(support), sum(support) FROM report""",
            {"report": oracles.REPORT},
        ),
        "roc_curve": Entry(
            lambda fx: evaluate.roc_curve(fx.scores), ["threshold", "fpr", "tpr"],
            "SELECT threshold, fp / CAST(neg AS DOUBLE) AS fpr, tp / CAST(pos AS DOUBLE) AS tpr FROM corners "
            "UNION ALL SELECT NULL, 0, 0",
        ),
        "roc_auc": Entry(
            lambda fx: evaluate.roc_auc(fx.scores), ["roc_auc"],
            """
SELECT (sum(r) FILTER (WHERE label = 1) - max(pos) * (max(pos) + 1) / 2.0) / (max(pos) * CAST(max(neg) AS DOUBLE)) AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
             sum(label) OVER () AS pos, sum(1 - label) OVER () AS neg FROM scores)""",
        ),
        "pr_curve": Entry(
            lambda fx: evaluate.pr_curve(fx.scores), ["threshold", "precision", "recall"],
            "SELECT threshold, precision, recall FROM pr UNION ALL SELECT NULL, 1, 0",
        ),
        "f1_by_threshold": Entry(
            lambda fx: evaluate.f1_by_threshold(fx.scores), ["threshold", "precision", "recall", "f1"],
            "SELECT * FROM f1s",
        ),
        "tune_threshold": Entry(
            lambda fx: evaluate.tune_threshold(fx.scores),
            ["optimal_threshold", "optimal_precision", "optimal_recall", "optimal_f1",
             "default_threshold", "default_precision", "default_recall", "default_f1"],
            "SELECT * FROM tuned",
        ),
        "apply_threshold": Entry(
            lambda fx: evaluate.classification_metrics(evaluate.apply_threshold(
                fx.scores, evaluate.tune_threshold(fx.scores).select("optimal_threshold").scalar()
            )),
            ["accuracy", "precision", "recall", "f1"], oracles.MEASURES.format(counts="tuned_counts"),
        ),
        "select_features": Entry(
            lambda fx: evaluate.select_features(correlations(fx), SETTINGS.importance_share, SETTINGS.max_features),
            ["feature", "importance", "normalized_importance", "cumulative_importance", "rank", "selected"],
            f"""
SELECT c.*, CASE WHEN rank <= CASE WHEN within <= {SETTINGS.max_features} THEN greatest(within, 1) ELSE {SETTINGS.max_features} END
            THEN 1 ELSE 0 END AS selected
FROM cumulated c, (SELECT count(*) AS within FROM cumulated WHERE cumulative_importance <= {SETTINGS.importance_share}) n""",
            {
                "importances": IMPORTANCES_SQL,
                "ranked": oracles.RANKED,
                "cumulated": "SELECT r.*, (SELECT sum(q.normalized_importance) FROM ranked q WHERE q.rank <= r.rank) "
                             "AS cumulative_importance FROM ranked r",
            },
        ),
    }
