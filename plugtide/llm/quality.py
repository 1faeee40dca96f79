"""Quality scores of texts: a linear hinge-loss model on n-gram indicators scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide.llm.words import coded, lowered, mixed, raw, rows_of, slices, split_words

# Labelled rows that the fit uses at most, on average over hashes; a fifth of them sets the sigmoid.
SAMPLE = 20_000
BITS = 16
# Added to the counts of each indicator.
SMOOTHING = 1.0
# Cost of a margin error, and how far the weights are drawn to their mean size: all the way would
# leave the plain ratios of the classes.
COST = 1.0
DRAWN = 0.25
ROUNDS = 20
# From this score on a document is predicted to be of quality 1.
KEEP = 0.7


def _hashes(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each ragged row of small numbers; none of the rows is empty."""
    place = np.arange(len(symbols)) - starts[:-1][rows_of(starts)]
    powers = np.cumprod(np.full(int(place.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return mixed(np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers[place], starts[:-1]))


# Letters of a kind count as one sign; all other ASCII characters stand for themselves.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")
_KIND[128:] = ord("a")


def _word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per distinct word: a hash of the word in lower case, and one of its shape.

    The shape is the word with each run of small letters, capitals, digits or one other sign cut to
    a single character.
    """
    data, starts = raw(words)
    kinds = _KIND[data]
    first = np.ones(len(data), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    first[starts[:-1]] = True
    passed = np.concatenate([[0], np.cumsum(first)])
    return _hashes(lowered(data), starts), _hashes(kinds[first], passed[starts])


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indicators of each text, as hashes of `BITS` bits, and where each text's begin.

    Indicators are words, and one to three neighbouring word shapes, where a word that repeats the
    one before it has a shape of its own.
    """
    words, starts = split_words(texts, lower=False)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    places, distinct = coded(words)
    own, shape = (h[places] for h in _word_hashes(distinct))
    rows = rows_of(starts)
    inner = np.concatenate([[False], rows[1:] == rows[:-1]])
    same = inner & np.concatenate([[False], places[1:] == places[:-1]])
    shape = np.where(same, np.uint64(0x5851F42D4C957F2D), shape)
    two = np.where(inner, mixed(np.roll(shape, 1) * np.uint64(3) + shape), shape)
    inner2 = inner & np.concatenate([[False], inner[:-1]])
    three = np.where(inner2, mixed(np.roll(two, 1) * np.uint64(5) + shape), two)
    grams = np.stack([own, mixed(shape), two, three]) >> np.uint64(64 - BITS)
    keys = np.unique((rows << BITS) + grams.astype(np.int64))
    return keys & ((1 << BITS) - 1), np.searchsorted(keys, np.arange(len(texts) + 1) << BITS)


@dataclass
class Model:
    """Weights per indicator, the constant's weight, and the sigmoid that makes scores of margins."""

    weights: np.ndarray
    constant: float
    slope: float
    offset: float

    def margins(self, found: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Margins of texts; longer texts have more indicators, so the sum is divided by their root."""
        rows, size = rows_of(starts), len(starts) - 1
        sums = np.bincount(rows, self.weights[found], size) if len(found) else np.zeros(size)
        return sums / np.sqrt(np.maximum(np.diff(starts), 1)) + self.constant

    def scores(self, found: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(found, starts) + self.offset, -500, 500)))


def fit(found: list[np.ndarray], labels: np.ndarray) -> Model:
    """Every fifth row sets the sigmoid, the others the weights. One class alone gives its share of rows."""
    positive = labels == 1
    if not len(labels) or positive.all() or not positive.any():
        share = (positive.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
    held = np.arange(len(labels)) % 5 == 4
    if positive[~held].all() or not positive[~held].any():
        held[:] = False
    size = 1 << BITS

    def share(label: bool) -> np.ndarray:
        own = [f for f, h, p in zip(found, held, positive) if not h and p == label]
        counts = SMOOTHING + np.bincount(np.concatenate(own).astype(np.int64), minlength=size)
        return counts / counts.sum()

    ratio = np.log(share(True)) - np.log(share(False))
    weights, constant = _descend(found, positive, ~held, ratio)
    weights = DRAWN * np.abs(weights).mean() + (1 - DRAWN) * weights
    model = Model(ratio * weights, constant, 1.0, 0.0)
    both = held.any() and positive[held].any() and not positive[held].all()
    rows = np.flatnonzero(held) if both else np.arange(len(labels))
    starts = np.concatenate([[0], np.cumsum([len(found[i]) for i in rows])]).astype(np.int64)
    margins = model.margins(np.concatenate([found[i] for i in rows]).astype(np.int64), starts)
    model.slope, model.offset = _sigmoid(margins, positive[rows])
    return model


def _descend(found, positive, used, ratio) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one dual variable after another is set to its best.

    A class counts in inverse proportion to its rows.
    """
    y = np.where(positive, 1.0, -1.0)
    rows = np.flatnonzero(used)
    values = {i: ratio[found[i]] / np.sqrt(max(len(found[i]), 1)) for i in rows}
    norm = {i: float(values[i] @ values[i]) + 1.0 for i in rows}
    of_class = np.where(positive, positive[rows].sum(), (~positive[rows]).sum())
    cost = COST * len(rows) / (2 * of_class)
    alpha, weights, constant = np.zeros(len(y)), np.zeros(1 << BITS), 0.0
    shuffled = np.random.default_rng(7)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in shuffled.permutation(rows):
            x, at = values[i], found[i]
            gradient = y[i] * (weights[at] @ x + constant) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weights[at] += step * x
                constant += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-3:
            break
    return weights, constant


def _sigmoid(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that fits the labels, by Newton's steps on the log loss."""
    target = np.where(positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        weight = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        cross = (weight * margins).sum()
        h = np.array([[(weight * margins**2).sum() + 1e-3, cross], [cross, weight.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model fitted in one task on at most about `sample` labelled rows that are not held out.

    The rows are those with the smallest hashes of their ids, so their ids can be broadcast and the
    texts are read in place. Rows without id or label teach nothing; of several labels of an id the
    smallest counts.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~is_held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    share = min(1.0, sample / max(1, known.count()))
    taken = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(taken), "_id")
    featured = rows.select(F.xxhash64("_id").alias("key"), F.col("_label").alias("label"), "text").mapInArrow(
        _featured, "key long, label int, found binary"
    )
    # One task fits: it gets the sample's indicators, which the sample's size bounds.
    numbers = "weights binary, constant double, slope double, offset double"
    fitted = featured.repartition(1).mapInArrow(_fitted, numbers).first()
    weights = np.frombuffer(fitted.weights, np.float32).astype(np.float64)
    return Model(weights, fitted.constant, fitted.slope, fitted.offset)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found, starts = indicators(batch.column("text"))
        own = [found[a:b].astype("<u4").tobytes() for a, b in zip(starts, starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("label"), pa.array(own, pa.binary())], ["key", "label", "found"]
        )


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    found = [np.frombuffer(f, "<u4") for _, _, f in rows]
    model = fit(found, np.array([label for _, label, _ in rows], np.int64))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
            *(pa.array([float(v)]) for v in (model.constant, model.slope, model.offset)),
        ],
        ["weights", "constant", "slope", "offset"],
    )


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "_quality") -> DataFrame:
    """`docs` with a score from 0 to 1 in a new column.

    Null and empty texts have no indicators and get the constant's score.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.constant, model.slope, model.offset))

    # Only the texts go to Python, and only the scores come back.
    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learned = Model(*shared.value)
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [learned.scores(*indicators(b.column("text"))) for b in slices(iter([batch]), "text")]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return docs.withColumn(score_col, scored(F.col(text_col).cast("string")))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    Words and shapes of the text alone decide. One pass reads the sampled texts, one scores all.

    A null text counts as empty; empty texts all get one score. Rows without an id or a label teach
    nothing but are scored; repeated rows are each scored, alike. A document with two labels counts once
    for each. Labels of one class, or none, give every row the same score. An empty table gives
    an empty one; other columns are not looked at.
    """
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return score(rows, model, score_col="score").select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without those scored below `KEEP`, all columns as they came.

    Null and empty texts, null ids and repeated rows go or stay by their score, as in
    `score_documents`; where labels teach nothing all rows go or all stay. An empty table stays empty.
    """
    scored = score(docs, train(docs, labels, id_col, text_col), text_col)
    return scored.filter(F.col("_quality") >= KEEP).select(*docs.columns)
