from __future__ import annotations

import numpy as np
import pytest

from plugtide.llm import ann, queries


def plain(rows, every, neighbours):
    """Neighbours by brute force, of rows (id, vector)."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, v in good:
        if q % every == 0:
            scored = [(-(x @ v) / np.linalg.norm(x) / np.linalg.norm(v), i) for i, x in good if i != q]
            out[q] = sorted(scored)[:neighbours]
    return out


def test_recall_of_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = plain(rows, 50, 5)
    got = queries.op5_nearest_neighbours(spark, "/root/testdata/sf0.01").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, best in want.items():
        own = sorted(by[q])
        assert [k for k, _, _ in own] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            x, y = vectors[i], vectors[q]
            assert s == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y), abs=1e-12)
        hits += len({i for _, i in best} & {i for _, i, _ in own})
    assert hits / (5 * len(want)) >= 0.9


def test_index_finds_all_codes_within_the_radius():
    draw = np.random.default_rng(4)
    codes = draw.integers(0, 256, (500, 6)).astype(np.uint8)
    codes[250:] = codes[:250] ^ (draw.random((250, 6)) < 0.2)
    index = ann.Index(codes)
    maker = ann.Codes(draw.normal(size=(50, 24)), 3)
    errors = np.arange(256)
    for radius in (0, 3, 7, 15, 40, 48):
        probes = [errors[ann._WEIGHT <= most] for most in maker.allowed(radius)]
        for code in codes[:40]:
            near = np.unpackbits(codes ^ code, axis=1).sum(axis=1) <= radius
            assert index.within(code, radius, probes).tolist() == np.flatnonzero(near).tolist()


def test_odd_vectors_ties_and_short_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, []),
        (6, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [1.0, None, 0.0]), (None, [1.0, 0.0, 0.0]),
        (10, [1.0, 0.0]), (50, [1.0, 1.0, 0.0]), (50, [1.0, 1.0, 0.0]), (100, [0.0, 0.0, 0.0]),
    ]
    table = spark.createDataFrame([(i, v, "r", 1) for i, v in rows], "vec_id long, embedding array<float>, rank string, rows int")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest(table).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 50), (0, 5, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    assert ann.nearest(table.filter("false")).collect() == []


def test_copies_beyond_a_block(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=16).tolist() if i % 3 else [1.0] * 16) for i in range(600)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = plain(rows, 50, 5)
    for q in (0, 150, 300):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [i for _, i in want[q]]
    assert len(got) == 60
