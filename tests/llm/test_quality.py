from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from plugtide.llm import quality, queries
from tests.llm.helpers import ODD_TEXTS, crc, no_documents, odd_documents

SF01 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = queries.op1_quality_classifier(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in known]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (8, 1, 1), (9, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD_TEXTS)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert quality.keep_good(docs, labels).columns == docs.columns


@pytest.mark.parametrize("rows", [[], [(6, 1)], [(6, 0), (7, 0)]])
def test_one_class_or_none(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    scores = {r.score for r in quality.score_documents(odd_documents(spark), labels).collect()}
    assert len(scores) == 1
    assert quality.score_documents(no_documents(spark), labels).collect() == []


def test_descent_reaches_the_optimum():
    """At the optimum no dual variable can improve: its gradient agrees with its bounds."""
    draw = np.random.default_rng(2)
    found = [np.unique(draw.integers(0, 40, 8)) for _ in range(120)]
    positive = np.array([f.mean() + draw.normal() * 3 > 19 for f in found])
    ratio = np.concatenate([draw.normal(size=40), np.zeros((1 << quality.BITS) - 40)])
    rounds, quality.ROUNDS = quality.ROUNDS, 4000
    try:
        weights, constant = quality._descend(found, positive, np.ones(120, bool), ratio)
    finally:
        quality.ROUNDS = rounds
    y = np.where(positive, 1.0, -1.0)
    cost = quality.COST * np.where(positive, 120 / (2 * positive.sum()), 120 / (2 * (~positive).sum()))
    x = np.zeros((120, 41))
    for i, f in enumerate(found):
        x[i, f] = ratio[f] / np.sqrt(len(f))
    x[:, 40] = 1
    w = np.append(weights[:40], constant)
    primal = 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    for _ in range(200):
        near = w + draw.normal(size=41) * 0.05
        assert 0.5 * near @ near + (cost * np.maximum(0, 1 - y * (x @ near))).sum() > primal - 1e-2


def test_indicators_tell_shapes_and_repeats():
    texts = ["the cat sat", "THE!! CAT!! SAT!!", "cat cat cat cat", "", None]
    found, starts = quality.indicators(pa.array(texts))
    sets = [set(found[a:b].tolist()) for a, b in zip(starts, starts[1:])]
    assert sets[0] != sets[1] and not sets[3] and not sets[4]
    assert sets[2] - sets[0]


def plain_indicators(text):
    """The distinct indicators of a text, as tuples."""
    found, words = set(), re.findall(r"[^\x20\x09-\x0D]+", text or "")
    shapes = []
    for k, word in enumerate(words):
        kinds = "".join(
            "a" if b >= 128 or chr(b).islower() else "A" if chr(b).isupper() else "0" if chr(b).isdigit() else chr(b)
            for b in word.encode()
        )
        shapes.append("same" if k and word == words[k - 1] else ("shape", re.sub(r"(.)\1+", r"\1", kinds, flags=re.S)))
        found.add(("word", re.sub("[A-Z]", lambda m: m.group().lower(), word)))
        found.add(("one", shapes[-1]))
        found.add(("run", *shapes[max(0, k - 1) :]))
        found.add(("run", *shapes[max(0, k - 2) :]))
    return found


def test_indicators_and_scores_equal_a_plain_version():
    draw = np.random.default_rng(5)
    vocabulary = ["the", "The", "THE", "a1b", "99", "--", "x--y", "é", "naïve", "end.", "aa", "b"]
    texts = [" ".join(draw.choice(vocabulary, draw.integers(0, 30))) for _ in range(60)] + [None, " ", "one"]
    found, starts = quality.indicators(pa.array(texts))
    sets = [set(found[a:b].tolist()) for a, b in zip(starts, starts[1:])]
    plain = [plain_indicators(t) for t in texts]
    # Each plain indicator has a number of its own, the same in every text.
    number = {}
    for one, two in zip(sets, plain):
        assert len(one) == len(two)
    for name in set().union(*plain):
        holders = [s for s, p in zip(sets, plain) if name in p]
        others = set().union(*[s for s, p in zip(sets, plain) if name not in p])
        number[name] = set.intersection(*holders) - others
    assert all(number.values())
    labels = np.array([int("99" in (t or "")) for t in texts])
    rows = [np.array(sorted(s), np.int64) for s in sets]
    model = quality.fit(rows, labels)
    for s, score in zip(rows, model.scores(found, starts)):
        margin = sum(model.weights[i] for i in s) / math.sqrt(max(len(s), 1)) + model.constant
        assert score == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))))
    # The weights are ratios of smoothed shares, scaled by what the descent found.
    used = [k for k in range(len(rows)) if k % 5 != 4]
    totals = [quality.SMOOTHING * (1 << quality.BITS) + sum(len(rows[k]) for k in used if labels[k] == y) for y in (0, 1)]
    for i in rows[0][:20]:
        counts = [quality.SMOOTHING + sum(i in rows[k] for k in used if labels[k] == y) for y in (0, 1)]
        ratio = math.log(counts[1] / totals[1]) - math.log(counts[0] / totals[0])
        assert (ratio == pytest.approx(0, abs=1e-12)) == (model.weights[i] == pytest.approx(0, abs=1e-12))
