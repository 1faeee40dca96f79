from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from plugtide.llm import queries, substrings
from tests.llm.helpers import ODD_TEXTS, SF, no_documents, odd_documents


def plain(docs, window):
    """(id, n_words, n_removed, digest of what is left), from every window of every text."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    order = [substrings.LAST if i is None else i for i, _ in split]
    least = {}
    for place, (_, w) in zip(order, split):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, place), place)
    out = []
    for place, (i, w) in zip(order, split):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < place:
                gone.update(range(k, k + window))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("removed_spans").collect()), key=str)


@pytest.mark.parametrize("period", sorted(substrings.COVERS))
def test_every_distance_has_two_members(period):
    cover = substrings.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [1, 4, 6, 50])
def test_odd_rows(spark, window):
    docs = odd_documents(spark)
    assert found(substrings.repeated_passages(docs, window=window)) == plain(ODD_TEXTS, window)


def test_passages_at_all_distances_and_lengths(spark):
    """Shared runs of 49 to 120 words at random places, whole copies, and repeats inside a text."""
    rng = random.Random(3)
    fresh = iter(range(10**6))
    passages = [[f"p{k}w{j}" for j in range(length)] for k, length in enumerate([49, 50, 51, 60, 80, 81, 120])]
    texts = []
    for i in range(120):
        words = [f"w{next(fresh)}" for _ in range(rng.randrange(70))]
        for p in rng.sample(passages, 2):
            words += p + [f"w{next(fresh)}" for _ in range(rng.randrange(40))]
        texts.append((i, " ".join(words)))
    texts += [(1000 + i, texts[i][1].replace(" ", "\n", 3)) for i in range(10)]
    texts += [(2000, " ".join(passages[4] * 3)), (5, texts[7][1]), (None, texts[9][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert found(substrings.repeated_passages(docs)) == plain(texts, 50)


def test_a_passage_and_a_text_in_a_third_of_the_rows(spark):
    common = " ".join(f"c{k}" for k in range(64))
    texts = [(i, f"{common} own{i}" if i % 3 == 0 else " ".join(f"x{i}y{k}" for k in range(55)) if i % 3 == 1 else common) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    assert found(substrings.repeated_passages(docs)) == plain(texts, 50)


def test_hot_hashes_that_are_not_broadcast(spark, monkeypatch):
    from plugtide.functions import lookups

    monkeypatch.setattr(lookups.attach, "__defaults__", (None, 0))
    common = [f"c{k}" for k in range(70)]
    texts = [(i, " ".join([f"a{i}"] * (i % 40) + common[: 50 + i % 20])) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    assert found(substrings.repeated_passages(docs)) == plain(texts, 50)


def test_empty_table(spark):
    assert substrings.repeated_passages(no_documents(spark)).collect() == []


def test_cut_texts_keep_all_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e", "k"), (2, "x  b c d e\ny", "l"), (3, None, "m"), (4, "q  r", "n")], "doc_id long, text string, key string"
    )
    left = substrings.drop_passages(docs, window=4)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "a b c d e", 2: "x y", 3: None, 4: "q  r"}


def test_against_sql(spark):
    got = queries.op11_substring_dedup(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op11_substring_dedup"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r.n_removed for r in got) > 0
