from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from plugtide.llm import neardup, queries
from plugtide.llm.components import components
from tests.llm.helpers import ODD_TEXTS, SF, near_components, no_documents, odd_documents, shingle_set


def check(spark, texts, size, percent):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = near_components(texts, size, percent)
    for r in neardup.near_duplicates(docs, shingle=size, percent=percent).collect():
        assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
        assert r.n_shingles == len(shingle_set(texts[r.doc_id], size))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_given_documents(spark, size, percent):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    check(spark, texts, size, percent)


def test_against_sql(spark):
    got = queries.op4_near_dedup(spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.sql(queries.ORACLE_SQL["op4_near_dedup"]).fetchall())


def test_chains_copies_and_common_passages(spark, monkeypatch):
    """A drifting chain, one text copied and changed many times, and a passage that all share; small tiles."""
    monkeypatch.setattr(neardup, "TILE", 16)
    draw = random.Random(5)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    passage, texts = new(60), []
    chain = new(120)
    for _ in range(25):
        texts.append(list(chain))
        chain[draw.randrange(120)] = new(1)[0]
    root = new(100)
    for _ in range(120):
        copy = list(root)
        for _ in range(draw.randrange(6)):
            copy[draw.randrange(100)] = new(1)[0]
        texts.append(copy)
    texts += [root] * 40
    texts += [new(draw.randrange(5, 60)) + passage for _ in range(80)]
    texts += [["a"], ["a"], ["a", "b"], [], []]
    draw.shuffle(texts)
    check(spark, {i: " ".join(t) for i, t in enumerate(texts)}, 3, 85)


def test_odd_rows(spark):
    rows = neardup.near_duplicates(odd_documents(spark), shingle=3, percent=85).collect()
    assert len(rows) == len(ODD_TEXTS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert got == {
        1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 5, True), 6: (5, 6, True),
        7: (5, 6, False), 8: (5, 6, False), 9: (got[9][0], 9, True), 10: (2, 10, True), 11: (1, 11, True), 12: (2, 10, False),
    }
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(no_documents(spark)).collect() == []
    docs = odd_documents(spark)
    left = neardup.drop_near(docs, shingle=3, percent=85)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 6, 9, 10, 11]


def test_keys_cover_the_distance():
    """Any two signatures within the distance share a key."""
    draw = np.random.default_rng(3)
    for _ in range(300):
        one = draw.integers(0, 1 << 16, neardup.VALUES).astype(np.uint16)
        two = one.copy()
        at = draw.choice(neardup.VALUES, neardup.DISTANCE, replace=False)
        two[at] += draw.integers(1, 1 << 16, len(at)).astype(np.uint16)
        keys = neardup.chunk_keys(np.stack([one, two]))
        assert (keys[0] == keys[1]).any()
        differ = (one != two).reshape(1, neardup.CHUNKS, neardup.CHUNK)
        assert neardup._first_shared(differ)[0] == np.flatnonzero(keys[0] == keys[1])[0]


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)]
    edges += [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(70)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {x for x in parent if all(a == b for a, b in edges if x in (a, b))}
    assert got == {x: find(x) for x in parent if x not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_stay_small_in_a_large_bucket(spark, monkeypatch):
    """Rows are counted as often as tiles repeat them, so no group grows with a bucket."""
    monkeypatch.setattr(neardup, "TILE", 16)
    plain = neardup._compared

    def counted(*reaches):
        inside = plain(*reaches)

        def compare(table):
            if len(table) > 24 * 16:
                raise ValueError(f"{len(table)} rows in a group")
            return inside(table)

        return compare

    monkeypatch.setattr(neardup, "_compared", counted)
    count = 600
    rows = lambda make, schema: spark.createDataFrame([make(i) for i in range(count)], schema)
    signature = np.arange(neardup.VALUES, dtype=np.uint16)
    signed = [(signature + np.uint16(1000) * (np.arange(neardup.VALUES) >= 5) * np.uint16(i % 60 + 1)).tobytes() for i in range(count)]
    members = rows(lambda i: (7, 0, i), "key long, slot int, node long")
    nodes = rows(lambda i: (i, bytearray(signed[i])), "node long, signature binary")
    sets = rows(lambda i: (i, bytearray(neardup.SKETCH)), "node long, sketch binary")
    label = spark.createDataFrame([], "node long, component long")
    got = {tuple(r) for r in neardup._rest_of_pairs(members, nodes, sets, label, 80, False).collect()}
    assert got == {(i, j) for i in range(count) for j in range(i + 60, count, 60)}
    # The nearest alone: at most one for a node and tile, and one at least for each node.
    near = {tuple(r) for r in neardup._rest_of_pairs(members, nodes, sets, label, 80, True).collect()}
    assert near <= got and len(near) < count * -(-count // 16) and {x for p in near for x in p} == set(range(count))


def test_pairs_grow_with_members_of_a_group(spark, monkeypatch):
    """Near copies of one text: twice the members make about twice the pairs, not four times."""
    plain, seen = neardup._linked, []

    def counted(pairs, sets, percent):
        pairs = neardup.durable(pairs, "pairs")
        seen[-1] += pairs.count()
        return plain(pairs, sets, percent)

    monkeypatch.setattr(neardup, "_linked", counted)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for i in range(240):
        own = list(base)
        for k in rng.sample(range(300), 2):
            own[k] = f"x{i}y{k}"
        texts.append((i, " ".join(own)))
    for count in (120, 240):
        seen.append(0)
        docs = spark.createDataFrame(texts[:count], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, shingle=3, percent=85).collect()}
        assert got == near_components(dict(texts[:count]), 3, 85)
    assert seen[1] < 3 * seen[0] and seen[1] < 12 * 240


def test_members_that_are_not_quite_similar_stay_in_their_task(spark, monkeypatch):
    """One text changed often: any two copies share 0.78 of their words, and few of such pairs are written out."""
    draw, texts = random.Random(3), {}
    base = [f"w{k}" for k in range(300)]
    for k in range(120):
        words = list(base)
        for at in draw.sample(range(300), 19):
            words[at] = f"x{k}-{at}"
        texts[k] = " ".join(words)
    texts[120] = texts[7] + " y"
    written = []
    linked = neardup._linked
    monkeypatch.setattr(neardup, "_linked", lambda pairs, *rest: written.append(pairs.count()) or linked(pairs, *rest))
    check(spark, texts, 1, 85)
    assert sum(written[2:]) < 120 * 119 / 2 / 10


def test_sketches_tell_distances():
    """Sketches of 2,048 values with two bits differ in three quarters of the values that do."""
    one, two = np.arange(1000, dtype=np.uint64), np.arange(85, 1085, dtype=np.uint64)
    values = neardup.mixed(np.concatenate([np.sort(one), np.sort(two)]) + np.uint64(1 << 40))
    sketch = neardup.sketches(values, np.array([0, 1000, 2000]))
    assert sketch.shape == (2, 512)
    plain = [[(b >> s) & 3 for b in row for s in (0, 2, 4, 6)] for row in sketch.tolist()]
    apart = neardup.sketch_distances(sketch[:1], sketch[1:])[0]
    assert apart == sum(x != y for x, y in zip(*plain))
    assert abs(apart / 2048 / 0.75 - (1 - 915 / 1085)) < 0.05
