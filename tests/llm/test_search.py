from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from plugtide.llm import queries, search
from tests.llm.helpers import ODD_TEXTS, SF, no_documents, odd_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "one TWO three"), (2, "seven seven one"), (3, None), (4, "nothing here matches"), (5, ""), (1, "four"),
    (6, "word end É it s"), (6, "word end É it s"), (7, "x" * 30000),
]


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        asked = Counter(terms(text))
        scores = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // max(total, 1)
            s = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                for t, c in asked.items() if b[t]
            )
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def items_of(spark, rows=ITEMS):
    return spark.createDataFrame(
        [(i, t, 1.0, 2) for i, t in rows], "item_id long, text string, score double, doc_id int"
    ).repartition(2)


@pytest.mark.parametrize("pass_terms", [search.PASS_TERMS, 5])
@pytest.mark.parametrize("top", [3, 20])
def test_odd_rows_in_one_pass_and_in_many(spark, top, pass_terms):
    got = search.search(odd_documents(spark), items_of(spark), top, pass_terms=pass_terms)
    assert found(got) == plain(ODD_TEXTS, ITEMS, top)


def test_ties_across_classes_and_a_class_of_a_third(spark):
    """Equal scores from different bags go by id; one bag holds a third of all rows."""
    rng = random.Random(1)
    docs = [(rng.randrange(10**6), "alpha beta" if k % 3 == 0 else f"beta alpha filler{k % 5}" if k % 3 == 1 else f"gamma {'alpha ' * (k % 4)}") for k in range(900)]
    items = [(k, " ".join(rng.choices(["alpha", "beta", "gamma", "filler1", "none"], k=4))) for k in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    assert found(search.search(frame, items_of(spark, items))) == plain(docs, items, 20)


def test_steps_of_one_class(spark, monkeypatch):
    monkeypatch.setattr(search, "SCORES", 1)
    assert found(search.search(odd_documents(spark), items_of(spark), 3)) == plain(ODD_TEXTS, ITEMS, 3)


def test_steps_of_few_matches(spark, monkeypatch):
    monkeypatch.setattr(search, "MATCHES", 1)
    assert found(search.search(odd_documents(spark), items_of(spark), 3)) == plain(ODD_TEXTS, ITEMS, 3)


def test_matches_held_at_once_are_bounded(monkeypatch):
    """300 classes of 60 terms that are in each of 100 items: 1.8 million matches in one batch."""
    held, gather = [], search.gather
    monkeypatch.setattr(search, "gather", lambda *given: held.append(gather(*given)) or held[-1])
    item_of, begins = np.tile(np.arange(100), 60), np.arange(61) * 100
    bag = np.stack([np.arange(60, dtype="<i4"), np.ones(60, "<i4")], axis=1).tobytes()
    batch = pa.RecordBatch.from_pydict({"bag": [bag] * 300, "m": [100] * 300, "ids": [[d] for d in range(300)]})
    rank = search._rank((item_of, np.ones_like(item_of), begins), np.full(60, 7), pa.array(range(100)), 20, pa.int64())
    rows = pa.Table.from_batches(rank(iter([batch]))).to_pylist()
    assert sum(len(places) for places, _ in held) == 300 * 60 * 100
    assert max(len(places) for places, _ in held) <= 1 << 20
    assert [(r["item"], r["doc_id"]) for r in rows] == [(item, doc) for item in range(100) for doc in range(20)]


def test_ids_that_are_text(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "two one")], "item_id string, text string")
    assert [tuple(r)[:3] for r in search.search(docs, items, 2).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert search.search(no_documents(spark), items_of(spark)).collect() == []
    assert search.search(odd_documents(spark), nothing).collect() == []
    assert search.search(odd_documents(spark), nothing).columns == ["item_id", "rank", "doc_id", "score"]


def test_against_sql(spark):
    got = queries.op12_ranked_search(spark, SF).select("doc_id", "item_id", "rank", "score").collect()
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(f"SELECT doc_id, item_id, rank, score FROM ({queries.ORACLE_SQL['op12_ranked_search']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
