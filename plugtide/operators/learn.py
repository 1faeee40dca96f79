"""Classifiers: weights, random search, scores, importances, retraining.

All draws, folds and models are fitted side by side on one matrix of bins (`operators.trees`). The
driver holds drawn settings, trees and the one-row measures.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plugtide.config import Settings
from plugtide.functions.durable import durable
from plugtide.operators import evaluate, trees
from plugtide.operators.trees import Model, Plan

# name -> how rows are weighted
MODELS = {"forest": "balanced", "boosted_deep": "positive", "boosted_leaf": "balanced"}

# Search name -> the parameter of a plan; shares and subsets of features become numbers of features.
PARAMETERS = {
    "trees": "trees", "depth": "depth", "leaves": "leaves", "min_leaf": "min_leaf", "min_split": "min_split",
    "min_gain": "min_gain", "l1": "l1", "l2": "l2", "learning_rate": "learning_rate", "row_share": "row_share",
    "impurity": "impurity",
}
# These are drawn from a stream of their own.
DRAWN_APART = ("min_split", "leaves", "l1", "l2")
# The least sum of second derivatives in a leaf.
LEAST_WEIGHT = {"boosted_deep": 1.0, "boosted_leaf": 1e-3}
# Models searched in the same passes; only their hits and misses outlive them.
SIDE_BY_SIDE = 64
# Folds of rows that no fold holds out, and of rows that nothing is fitted on.
WHOLE, TEST = -1, -2


def class_weights(df: DataFrame) -> DataFrame:
    """Rows per label, with both weights: n / (2 n_c), and 1 against round(negatives / positives, 2)."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    both = Window.partitionBy()
    negatives = F.sum(F.when(F.col("label") == 0, F.col("rows"))).over(both)
    ratio = F.round(F.try_divide(negatives.cast("double"), F.col("rows").cast("double")), 2)
    return counts.select(
        "label",
        "rows",
        (F.sum("rows").over(both) / (2 * F.col("rows"))).alias("balanced"),
        F.when(F.col("label") == 1, ratio).otherwise(F.lit(1.0)).alias("positive"),
    )


def weights_of(scheme: str, rows: int, positives: int) -> tuple[float, float]:
    """The same weights from counts: of label 0, of label 1. A label without rows weighs 1."""
    negatives = rows - positives
    if not rows or not positives or not negatives:
        return 1.0, 1.0
    if scheme == "balanced":
        return rows / (2 * negatives), rows / (2 * positives)
    return 1.0, math.floor(negatives / positives * 100 + 0.5) / 100


def weighted(df: DataFrame, scheme: str) -> DataFrame:
    """Adds a `weight`, looked up in the two rows that `class_weights` gives for `df` itself."""
    weights = class_weights(df).select("label", F.col(scheme).alias("weight"))
    return df.join(F.broadcast(weights), "label")


def with_folds(df: DataFrame, keys: list[str], folds: int, apart: tuple[str, ...] = ()) -> DataFrame:
    """A fold number from a hash of the keys, the same on every run and every partitioning.

    Each label is spread evenly: rows are numbered per label and hash bucket, and the buckets start
    at different folds. A bucket holds some 1/4096 of a label's rows. Rows that differ in `apart` are numbered apart.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    df = df.withColumn("_digest", digest).withColumn("_bucket", F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int"))
    number = F.row_number().over(Window.partitionBy(*apart, "label", "_bucket").orderBy("_digest", *keys))
    return df.withColumn("fold", F.pmod(F.col("_bucket") + number, F.lit(folds))).drop("_digest", "_bucket")


def draw_settings(name: str, settings: Settings) -> list[dict]:
    """Seeded random draws from the model's search space: a list of values, or a range with both ends."""
    rng = random.Random(settings.seed)
    space = settings.search_spaces[name]

    def draw(values):
        if isinstance(values, list):
            return rng.choice(values)
        low, high = values
        return rng.randint(low, high) if isinstance(low, int) else rng.uniform(low, high)

    first = {p: values for p, values in space.items() if p not in DRAWN_APART}
    drawn = [{p: draw(values) for p, values in first.items()} for _ in range(settings.search_iterations)]
    rng = random.Random(settings.seed + 1)
    return [d | {p: draw(values) for p, values in space.items() if p not in first} for d in drawn]


def plan(name: str, drawn: dict, settings: Settings, features: list[int], rows: int, positives: int, **where) -> Plan:
    """What to fit for drawn settings on rows of which so many are positive."""
    count = len(features)
    arguments = {PARAMETERS[p]: v for p, v in drawn.items() if p in PARAMETERS}
    if "feature_share" in drawn:
        arguments["tree_features"] = max(1, math.floor(drawn["feature_share"] * count))
    if "feature_subset" in drawn:
        subset = {"sqrt": math.isqrt(count), "log2": int(math.log2(count)), "all": 0}
        arguments["node_features"] = subset[drawn["feature_subset"]] and max(1, subset[drawn["feature_subset"]])
    return Plan(
        name, forest=name == "forest", weights=weights_of(MODELS[name], rows, positives), seed=settings.seed,
        features=tuple(features), min_weight=LEAST_WEIGHT.get(name, 0.0), **arguments, **where,
    )


@dataclass
class Search:
    """The drawn settings, and per draw and fold: rows and positives held out, hits and misses, F1."""

    drawn: list[dict]
    tried: list[tuple[int, int, int, int, int, int, int, int, float]]

    @property
    def best(self) -> int:
        """The draw with the best mean F1, the first of equals."""
        means = [0.0] * len(self.drawn)
        for number, *_, f1 in self.tried:
            means[number] += f1
        return max(range(len(means)), key=means.__getitem__)


@dataclass
class Matrix:
    """The binned rows, written: keys, label, is_train, fold, row_hash, bins; and rows and positives per fold."""

    rows: DataFrame
    features: list[str]
    edges: list
    sizes: dict[int, tuple[int, int]]

    @property
    def train(self) -> DataFrame:
        return self.rows.filter("is_train")

    def fitted_on(self, held_out: int) -> tuple[int, int]:
        """Rows and positives outside a fold."""
        own = [size for fold, size in self.sizes.items() if fold != held_out]
        return sum(n for n, _ in own), sum(p for _, p in own)


def binned(matrix: DataFrame, settings: Settings, edge_rows: int = trees.EDGE_ROWS) -> Matrix:
    """The matrix with folds and bins, from values rounded to six places.

    An unknown measure, such as a power of 0 / 0, counts as 0.

    The bins' borders are quantiles of all training rows; of more than `edge_rows` a sample says where to look for them.
    All rows are binned, fitted and scored.
    """
    features, keys = settings.features, _keys(matrix, settings)
    filled = [F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in features]
    rows = matrix.select(*keys, F.col("label").cast("int").alias("label"), "is_train", *filled)
    rows = rows.withColumn("row_hash", trees.row_hash(keys)).filter("is_train IS NOT NULL")
    edges = trees.all_edges(rows.filter("is_train"), features, edge_rows, places=trees.PLACES)
    # Bins are a byte a feature: the shuffle into folds carries those and not the values.
    packed = with_folds(trees.binned(rows, features, edges, trees.PLACES), keys, settings.folds, ("is_train",))
    packed = packed.withColumn("fold", F.when(F.col("is_train"), F.col("fold")).otherwise(F.lit(TEST)))
    written = durable(packed, "bins")
    counts = written.filter("is_train").groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"))
    return Matrix(written, features, edges, {r.fold: (r.n, int(r.p)) for r in counts.collect()})


def fit(matrix: Matrix, plans: list[Plan]) -> list[Model]:
    """All plans, side by side."""
    grown = trees.fit(matrix.train, plans, len(matrix.features))
    return [Model(p, t, matrix.features, matrix.edges) for p, t in zip(plans, grown)]


def random_search(matrix: Matrix, names: list[str], settings: Settings) -> dict[str, Search]:
    """F1 of the positive class for every drawn setting, on each fold after a fit on the others.

    Weights come from the rows of a fit alone.
    """
    searches = {name: Search(draw_settings(name, settings), []) for name in names}
    everything = list(range(len(matrix.features)))
    plans = [
        plan(name, drawn, settings, everything, *matrix.fitted_on(fold), draw=number, held_out=fold)
        for name in names for number, drawn in enumerate(searches[name].drawn) for fold in range(settings.folds)
    ]
    for p, (tn, fp, fn, tp) in zip(plans, trees.searched(matrix.train, plans, len(matrix.features), SIDE_BY_SIDE), strict=True):
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        rows, positives = matrix.sizes.get(p.held_out, (0, 0))
        searches[p.name].tried.append((p.draw, p.held_out, rows, positives, tp, fp, fn, tn, f1))
    return searches


def score(model: Model, matrix: Matrix) -> DataFrame:
    """The matrix's keys and label with `prediction` (0 / 1) and `score`, the probability of the positive class."""
    return trees.scored(matrix.rows, model)


def importances(spark: SparkSession, model: Model) -> DataFrame:
    return trees.importances(spark, model)


@dataclass
class Trained:
    """What one model leaves behind. `tables` holds, per run, the evaluation tables."""

    name: str
    search: Search
    model: Model
    settings: dict
    ranked: DataFrame
    selected: list[str]
    retrained: Model
    scored: dict[str, DataFrame] = field(default_factory=dict)
    tables: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    measures: list[tuple[str, str, str, float]] = field(default_factory=list)


RUNS = ("initial", "optimised")


def _keys(matrix: DataFrame, settings: Settings) -> list[str]:
    return [c for c in ("session_date", "day_period", settings.group) if c in matrix.columns]


def _evaluate(trained: Trained, run: str, scored: DataFrame, settings: Settings) -> None:
    """Measures and tables at the model's own threshold and at the one of best F1."""
    test = scored.filter(~F.col("is_train"))
    points = durable(evaluate.by_score(test), "points")
    auc = evaluate.auc_of(points).first()["roc_auc"]
    tune_on = evaluate.by_score(scored.filter("is_train")) if settings.tune_on == "train" else points
    tuned = evaluate.threshold_of(tune_on).first().asDict()
    at_best = evaluate.apply_threshold(scored, tuned["optimal_threshold"])
    rows = {}
    for kind, predicted in (("default", scored), ("optimal", at_best)):
        rows |= {f"{kind}_{k}": v for k, v in evaluate.classification_metrics(predicted).first().asDict().items()}
    # The points of the precision-recall curve nearest to one half and of best F1.
    rows |= {f"curve_{k}": v for k, v in tuned.items() if not k.endswith("_threshold")}
    rows |= {"optimal_threshold": tuned["optimal_threshold"], "default_threshold": tuned["default_threshold"], "roc_auc": auc}
    rows["features"] = len(settings.features if run == RUNS[0] else trained.selected)
    trained.measures += [(trained.name, run, k, None if v is None else float(v)) for k, v in rows.items()]
    trained.scored[run] = scored
    trained.tables[run] = evaluate.evaluation_tables(test, points, tuned["optimal_threshold"])


def train_models(matrix: DataFrame, settings: Settings, names: list[str] | None = None) -> list[Trained]:
    """Search, score with the best models, tune, select features, retrain on those, score again."""
    spark, names, ready = matrix.sparkSession, list(names or MODELS), binned(matrix, settings)
    searches = random_search(ready, names, settings)
    everything = list(range(len(ready.features)))

    def again(features: dict[str, list[int]]) -> list[Model]:
        best = {name: searches[name].drawn[searches[name].best] for name in names}
        return fit(ready, [plan(n, best[n], settings, features[n], *ready.fitted_on(WHOLE)) for n in names])

    trained, chosen = [], {}
    for name, model in zip(names, again(dict.fromkeys(names, everything))):
        ranked = evaluate.select_features(
            importances(spark, model).select("feature", "importance"), settings.importance_share, settings.max_features
        )
        selected = [r["feature"] for r in ranked.filter("selected").orderBy("rank").collect()]
        chosen[name] = sorted(ready.features.index(f) for f in selected)
        search = searches[name]
        trained.append(Trained(name, search, model, search.drawn[search.best], ranked, selected, model))
    trained = [replace(t, retrained=model) for t, model in zip(trained, again(chosen))]

    def judged(job: tuple[Trained, str]) -> None:
        t, run = job
        model = t.model if run == RUNS[0] else t.retrained
        _evaluate(t, run, durable(score(model, ready), "scored"), settings)

    with ThreadPoolExecutor(settings.fit_parallelism) as pool:
        list(pool.map(judged, [(t, run) for t in trained for run in RUNS]))
    for t in trained:
        t.measures.sort(key=lambda row: RUNS.index(row[1]))
    return trained


def model_results(spark: SparkSession, trained: list[Trained]) -> DataFrame:
    """All measures as rows (model, run, metric, value)."""
    rows = [row for t in trained for row in t.measures]
    return spark.createDataFrame(rows, "model string, run string, metric string, value double")


def result_tables(spark: SparkSession, trained: list[Trained]) -> dict[str, DataFrame]:
    """Everything to keep of a training: measures, hyper-parameters, search, importances, curves."""
    drawn = [(t.name, p, str(v)) for t in trained for p, v in t.settings.items()]
    tried = [(t.name, *row, row[0] == t.search.best) for t in trained for row in t.search.tried]
    result = {
        "measures": model_results(spark, trained),
        "hyper_parameters": spark.createDataFrame(drawn, "model string, parameter string, value string"),
        "search": spark.createDataFrame(
            tried,
            "model string, draw int, fold int, rows long, positives long, tp long, fp long, fn long, tn long, "
            "f1 double, best boolean",
        ),
        "importances": _union(_named(t.ranked, t.name) for t in trained),
        "trees": trees.tree_table(spark, [t.model for t in trained]),
    }
    for table in next(iter(trained[0].tables.values())):
        result[table] = _union(_named(t.tables[run][table], t.name, run) for t in trained for run in RUNS)
    return result


def _named(df: DataFrame, model: str, run: str | None = None) -> DataFrame:
    names: dict[str, Column] = {"model": F.lit(model)} | ({"run": F.lit(run)} if run else {})
    return df.select(*[c.alias(n) for n, c in names.items()], "*")


def _union(tables) -> DataFrame:
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first
