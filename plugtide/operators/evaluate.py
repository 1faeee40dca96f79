"""Measures of a scored table: a `label` of 0 / 1 with a `prediction` (0 / 1) or a `score`.

Counts are formed in one pass with map-side combine. Curves start from one row per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugtide import config
from plugtide.functions.ordered import previous_row, running_totals

CELLS = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def _counts(df: DataFrame) -> DataFrame:
    return df.agg(*[
        F.count_if((F.col("label") == actual) & (F.col("prediction") == predicted)).alias(cell)
        for cell, (actual, predicted) in CELLS.items()
    ])


def share(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f1_of(precision: Column, recall: Column) -> Column:
    return share(2 * precision * recall, precision + recall)


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Rows (actual, predicted, rows) for all four cells."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(cell).alias("rows"))
        for cell, (a, p) in CELLS.items()
    ])
    return _counts(df).select(F.inline(cells))


def classification_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, in one row.

    With an `is_train` column the measures are those of the test rows, and `accuracy_train` is
    added; both come from the same pass.
    """
    has_parts = "is_train" in df.columns
    test = ~F.col("is_train") if has_parts else F.lit(True)
    hit = F.col("label") == F.col("prediction")
    counts = [
        F.count_if(test & (F.col("label") == a) & (F.col("prediction") == p)).alias(cell)
        for cell, (a, p) in CELLS.items()
    ]
    if has_parts:
        counts += [
            F.count_if(F.col("is_train") & hit).alias("_train_hits"),
            F.count_if(F.col("is_train")).alias("_train"),
        ]
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    measures = [
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]
    if has_parts:
        measures.append(share(F.col("_train_hits"), F.col("_train")).alias("accuracy_train"))
    return df.agg(*counts).select(*measures)


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and their plain and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sizes = {0: tn + fp, 1: tp + fn}
    hits = {0: tn, 1: tp}
    called = {0: tn + fn, 1: tp + fp}
    precision = {k: share(hits[k], called[k]) for k in (0, 1)}
    recall = {k: share(hits[k], sizes[k]) for k in (0, 1)}
    f1 = {k: share(2 * hits[k], sizes[k] + called[k]) for k in (0, 1)}
    total = sizes[0] + sizes[1]

    def row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            f.alias("f1"), support.alias("support"),
        )

    def plain(m: dict[int, Column]) -> Column:
        return (m[0] + m[1]) / 2

    def weighted(m: dict[int, Column]) -> Column:
        return share(m[0] * sizes[0] + m[1] * sizes[1], total)

    accuracy = share(tp + tn, total)
    rows = F.array(
        *[row(config.BUSYNESS_ORDER[k], precision[k], recall[k], f1[k], sizes[k]) for k in (0, 1)],
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", plain(precision), plain(recall), plain(f1), total),
        row("weighted avg", weighted(precision), weighted(recall), weighted(f1), total),
    )
    return _counts(df).select(F.inline(rows))


def by_score(df: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score, and how many have at least that score."""
    distinct = df.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
    )
    return running_totals(
        distinct, "score", {"tp": "positives", "fp": "negatives"}, descending=True
    )


def _totals(points: DataFrame) -> DataFrame:
    """One row: all positives and all negatives."""
    return points.agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("all_positives"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("all_negatives"),
    )


def _with_totals(points: DataFrame) -> DataFrame:
    totals = _totals(points)
    return points.withColumns({
        "all_positives": totals.select("all_positives").scalar(),
        "all_negatives": totals.select("all_negatives").scalar(),
    })


def roc_curve(df: DataFrame, thin: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin with a NULL threshold.

    With `thin` a point is left out where the step to it and the step from it are the same; the line
    through the rest is the same line.
    """
    points = by_score(df)
    return _roc_points(corners(points) if thin else points)


def corners(points: DataFrame) -> DataFrame:
    """The rows of `by_score` at which the ROC curve may turn: the first, the last, and those whose
    step differs from the next one's. Slices of scores look no further than one border row."""
    nexts = {"_next_positives": "positives", "_next_negatives": "negatives"}
    # The next point of the curve has the next smaller score.
    steps = previous_row(points, ["score"], nexts)
    first = (F.col("tp") == F.col("positives")) & (F.col("fp") == F.col("negatives"))
    last = F.col("_next_positives").isNull()
    same = (F.col("positives") == F.col("_next_positives")) & (F.col("negatives") == F.col("_next_negatives"))
    return steps.filter(first | last | ~same).drop(*nexts)


def _roc_points(points: DataFrame) -> DataFrame:
    """Points of the curve from rows of `by_score`; the last of these counts all rows."""
    totals = points.agg(F.max("tp").alias("tp"), F.max("fp").alias("fp"))
    points = points.withColumns({
        "all_positives": totals.select("tp").scalar(), "all_negatives": totals.select("fp").scalar(),
    })
    curve = points.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("all_negatives").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_positives").cast("double")).alias("tpr"),
    )
    origin = points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def roc_auc(df: DataFrame) -> DataFrame:
    """Area under the ROC curve, in one row."""
    return auc_of(by_score(df))


def auc_of(points: DataFrame) -> DataFrame:
    """Trapezoids on the rows of `by_score`: every negative counts the positives above it, and half
    of those with its own score. The sums are whole numbers until the last division."""
    above = F.col("tp") - F.col("positives")
    wide = "decimal(38,0)"
    doubled = F.sum(F.col("negatives").cast("decimal(18,0)") * (2 * above + F.col("positives")).cast("decimal(19,0)"))
    pairs = F.sum("positives").cast("decimal(18,0)") * F.sum("negatives").cast("decimal(18,0)")
    return points.agg(
        F.try_divide(doubled.cast(wide).cast("double"), (2 * pairs).cast(wide).cast("double")).alias("roc_auc")
    )


def pr_curve(df: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (1, 0)."""
    return _with_end(_pr_points(by_score(df)))


def _with_end(curve: DataFrame) -> DataFrame:
    end = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def _pr_points(points: DataFrame) -> DataFrame:
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    precision = tp / (tp + fp)
    # Without any positive every threshold recalls all of them.
    recall = F.coalesce(F.try_divide(tp, F.col("all_positives").cast("double")), F.lit(1.0))
    return _with_totals(points).select(
        F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall")
    )


def f1_by_threshold(df: DataFrame) -> DataFrame:
    """The points of the precision-recall curve with their F1."""
    return _f1_points(by_score(df))


def _f1_points(points: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return _pr_points(points).withColumn("f1", 2 * (p * r) / (p + r + F.lit(1e-10)))


def tune_threshold(df: DataFrame) -> DataFrame:
    """One row: the point of best F1 (the lowest threshold among equals) and the point nearest to
    0.5, which stands for the untuned model."""
    return threshold_of(by_score(df))


def threshold_of(points: DataFrame) -> DataFrame:
    """The same from the rows of `by_score`."""
    point = F.struct("threshold", "precision", "recall", "f1")
    best = F.max_by(point, F.struct(F.col("f1"), -F.col("threshold")))
    default = F.min_by(point, F.struct(F.abs(F.col("threshold") - 0.5), F.col("threshold")))
    return (
        _f1_points(points)
        .agg(best.alias("_best"), default.alias("_default"))
        .select(
            F.col("_best.threshold").alias("optimal_threshold"),
            F.col("_best.precision").alias("optimal_precision"),
            F.col("_best.recall").alias("optimal_recall"),
            F.col("_best.f1").alias("optimal_f1"),
            F.col("_default.threshold").alias("default_threshold"),
            F.col("_default.precision").alias("default_precision"),
            F.col("_default.recall").alias("default_recall"),
            F.col("_default.f1").alias("default_f1"),
        )
    )


def apply_threshold(df: DataFrame, threshold: float | Column) -> DataFrame:
    """Predictions from scores: positive from the threshold on."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("prediction", F.when(F.col("score") >= threshold, 1).otherwise(0))


def evaluation_tables(scored: DataFrame, points: DataFrame, optimal_threshold: float) -> dict[str, DataFrame]:
    """Everything that is shown of a scored table: counts and report at both thresholds, and the curves.

    `scored` has label, score and the model's own prediction; `points` are its rows of `by_score`.
    """
    at = {"default": scored, "optimal": apply_threshold(scored, optimal_threshold)}

    def both(table) -> DataFrame:
        default, optimal = (table(df).select(F.lit(kind).alias("threshold_kind"), "*") for kind, df in at.items())
        return default.unionByName(optimal)

    return {
        "confusion_matrix": both(confusion_matrix),
        "classification_report": both(classification_report),
        "roc_curve": _roc_points(corners(points)),
        "pr_curve": _with_end(_pr_points(points)),
        "f1_by_threshold": _f1_points(points),
    }


def select_features(importances: DataFrame, share_kept: float = 0.90, at_most: int = 10) -> DataFrame:
    """Ranks features and marks those to keep, on a table with one row per feature.

    Kept are the features whose cumulated share stays within `share_kept` if those are few enough,
    otherwise the first `at_most`; the best feature is kept in any case.
    """
    ranked = Window.orderBy(F.col("importance").desc(), "feature")
    table = Window.partitionBy()
    normalized = F.try_divide(F.col("importance"), F.sum("importance").over(table))
    within = F.count_if(F.col("cumulative_importance") <= share_kept).over(table)
    limit = F.when(within <= at_most, F.greatest(within, F.lit(1))).otherwise(F.lit(at_most))
    return (
        importances.withColumn("normalized_importance", normalized)
        .withColumn(
            "cumulative_importance",
            F.sum("normalized_importance").over(ranked.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("rank", F.row_number().over(ranked))
        .withColumn("selected", F.col("rank") <= limit)
    )
