"""What a pass over the matrix sums and sends, and the rounding of values on their way into bins."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plugtide.operators import trees
from plugtide.plans import catalog, stages
from plugtide.plans.fixture import Fixture

SF = "/root/testdata/sf0.001"
WIDTH = 9


def batch(rows: int) -> pa.RecordBatch:
    rng = np.random.default_rng(3)
    bins = [bytes(r) for r in rng.integers(0, trees.BINS, (rows, WIDTH), np.uint8)]
    return pa.RecordBatch.from_arrays(
        [pa.array(rng.integers(0, 2, rows)), pa.array(np.zeros(rows, int)), pa.array(rng.integers(0, trees.PRIME, rows)), pa.array(bins)],
        ["label", "fold", "row_hash", "bins"],
    )


def test_only_features_that_may_split_a_node_are_summed():
    plan = trees.Plan("forest", forest=True, node_features=2, features=tuple(range(WIDTH)))
    growing = trees.Growing(plan, 0)
    arrays = growing.tree(final=False).arrays(lambda *_: 0.0)
    allowed = plan.allowed(0, 1)
    task = trees._Task(plan, 0, [], [(0, arrays, np.array([0]))])
    sent = next(trees._histograms([task], [allowed], WIDTH, trees.BINS)(iter([batch(500)])))
    at, a, b, n = np.frombuffer(sent.column("cells")[0].as_py(), np.int64).reshape(4, -1)
    assert {int(c) // trees.BINS for c in at} == set(allowed) and len(allowed) == 2
    given = batch(500)
    times = np.searchsorted(trees.DRAWN, trees._hashed(given.column("row_hash").to_numpy(), plan, 0), "right")
    assert n.sum() == 2 * (times > 0).sum() and (a + b).sum() == 2 * times.sum()


def test_sums_side_by_side_are_the_same_as_one_by_one():
    given = batch(300)
    columns, rows = trees._columns(given.slice(7, 200), WIDTH), np.arange(200)
    rng = np.random.default_rng(5)
    for a, b in (
        (rng.integers(0, 8, 200), rng.integers(0, 8, 200)),
        (rng.integers(-(1 << 26), 1 << 26, 200), rng.integers(0, 1 << 24, 200)),
        (rng.integers(-(1 << 40), 1 << 40, 200), rng.integers(0, 1 << 42, 200)),
    ):
        slot, slots = rng.choice([2, 5], 200), np.array([2, 5])
        total, want = (np.zeros((6, 3, WIDTH, trees.BINS), np.int64) for _ in range(2))
        trees._add(total, slots, (1, 4), columns, rows, slot, a.astype(float), b.astype(float))
        for r in rows:
            for f in (1, 4):
                want[slot[r], :, f, given.column("bins")[7 + r].as_py()[f]] += (a[r], b[r], 1)
        assert (total == want).all()


class Watched(np.ndarray):
    """Bins that note how many of a column's cells are picked by number."""

    picked: list[int] = []

    def __getitem__(self, key):
        if isinstance(key, np.ndarray):
            self.picked.append(len(key))
        return super().__getitem__(key)


def test_small_trees_are_walked_and_many_features_summed_without_picking_cells(monkeypatch):
    columns, rows = trees._columns(batch(500), WIDTH), np.arange(0, 500, 3)
    grown = trees.Tree({n: trees.Node((0, 0), 0, trees.Split(n % WIDTH, 30, 1.0, (0, 0, 0)) if n < 32 else None) for n in range(1, 64)})
    arrays = grown.arrays(lambda *_: 0.0)
    monkeypatch.setattr(Watched, "picked", [])
    places = trees._places(columns.view(Watched), arrays, rows)
    # One pick per tree: the rows' places at the end.
    assert len(Watched.picked) <= 1
    monkeypatch.setattr(trees, "AT_ONCE", 4)
    total, want = (np.zeros((1, 3, WIDTH, trees.BINS), np.int64) for _ in range(2))
    given = rows, np.zeros(len(rows), int), np.ones(len(rows)), np.ones(len(rows))
    trees._add(total, np.array([0]), range(WIDTH), columns.view(Watched), *given, np.ascontiguousarray(columns.T))
    assert len(Watched.picked) <= 1
    trees._add(want, np.array([0]), range(WIDTH), columns, *given)
    assert (total == want).all()
    monkeypatch.setattr(trees, "WALKED", 0)
    assert places.tolist() == trees._places(columns, arrays, rows).tolist() and len(set(places)) > 10


def test_values_are_rounded_as_spark_rounds_them(spark):
    values = [0.0, -0.0, 5e-7, -5e-7, 0.1234565, 0.123456499, -2.0000005, 1e-9, 123456.7891235, 1e12 + 0.1234567, 1e300, float("nan"), float("inf")]
    values += [float(x) for x in np.random.default_rng(1).normal(size=300) * 100]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    want = [r.r for r in df.select((F.round(F.col("v") + F.lit(trees.NUDGE), 6) + F.lit(0.0)).alias("r"), "k").orderBy("k").collect()]
    assert np.array(want).tobytes() == trees.rounded(np.array(values), 6).tobytes()
    assert trees.rounded(np.array(values), None).tolist()[2] == 5e-7


def test_small_batches_are_worked_on_together(monkeypatch):
    """What is done per node and feature does not multiply with the batches that a task gets."""
    plan = trees.Plan("boosted_deep", features=tuple(range(WIDTH)))
    arrays = trees.Growing(plan, 0).tree(final=False).arrays(lambda *_: 0.0)
    given, added = batch(500), []
    add = trees._add
    monkeypatch.setattr(trees, "_add", lambda *args: added.append(1) or add(*args))

    def sent(batches):
        task = trees._Task(plan, 0, [], [(0, arrays, np.array([0]))])
        found = list(trees._histograms([task], [plan.allowed(0, 1)], WIDTH, trees.BINS)(iter(batches)))
        return [b.column("cells").to_pylist() for b in found]

    small = [given.slice(k, 7) for k in range(0, 500, 7)]
    assert sent(small) == sent([given]) and len(added) == 2
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 100)
    assert sent(small) == sent([given]) and len(added) == 2 + 5 + 1
    assert list(trees._gathered(iter([]))) == []


def test_rows_are_binned_without_rounding_them():
    """A value lies above the unrounded border exactly where, rounded, it lies above the border."""
    rng = np.random.default_rng(0)
    values = np.concatenate([
        rng.normal(size=2000), rng.integers(0, 50, 500) / 7, np.round(rng.random(500), 6) + 5e-7, rng.normal(size=50) * 1e12,
        [np.inf, -np.inf, np.nan, 0.0, -0.0, 1e300, -1e300, 5e-7, 4.99e-7, 4.990000001e-7],
    ])
    for _ in range(10):
        borders = np.unique(trees.rounded(rng.choice(values, 63), 6))
        above = trees.unrounded(borders, 6)
        near = np.concatenate([values, above, np.nextafter(above, np.inf), np.nextafter(above, -np.inf), borders])
        assert (np.searchsorted(above, near) == np.searchsorted(borders, trees.rounded(near, 6))).all()
    assert trees.unrounded(borders, None) is borders


@pytest.mark.parametrize("settings", [catalog.BY_POINT, catalog.BY_STATION])
def test_split_and_shifts_share_a_shuffle(spark, settings):
    """The wide rows pass no second shuffle, and columns that no feature is made from are not carried."""
    features = catalog.written_features(Fixture(spark, SF), settings)
    plan = stages.model_table(features, settings)._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning({settings.group}" in plan
    assert not re.search(rf"hashpartitioning\(is_train#\d+, {settings.group}", plan)
    assert "last_session_pre_data" in features.columns and "last_session_pre_data" not in plan
