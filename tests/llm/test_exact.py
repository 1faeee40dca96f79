from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from plugtide.llm import exact, queries
from tests.llm.helpers import ODD_TEXTS, SF, no_documents, odd_documents


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected():
    groups = {}
    for i, t in ODD_TEXTS:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in ODD_TEXTS:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("content_hash", [None, lambda t: F.unhex(F.lit("00")), lambda t: F.unhex(F.substring(F.md5(t), 1, 2))])
def test_odd_rows_and_colliding_hashes(spark, content_hash):
    extra = {} if content_hash is None else {"content_hash": content_hash}
    rows = exact.exact_groups(odd_documents(spark), **extra).collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected()


def test_empty_table(spark):
    assert exact.exact_groups(no_documents(spark)).collect() == []
    assert exact.drop_exact(no_documents(spark)).collect() == []


def test_drop_keeps_columns_and_one_of_each(spark):
    docs = odd_documents(spark)
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns
    groups = {}
    for i, t in ODD_TEXTS:
        groups.setdefault(normal(t), []).append(i)
    want = [(min((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()]
    assert sorted(((r.doc_id, normal(r.text)) for r in left.collect()), key=str) == sorted(want, key=str)


def test_drop_follows_the_groups(spark):
    """Rows without an id, and rows that repeat an id, are told by id and text together."""
    rows = [(None, "x y", "p"), (None, "x  y", "q"), (1, "x y", "r"), (2, "other", "s"), (1, "other", "t"), (1, "x y", "u")]
    rows += [(None, "none", "v"), (None, "none", "w"), (3, None, "y"), (4, "", "z")]
    left = exact.drop_exact(spark.createDataFrame(rows, "doc_id long, text string, _sha string")).collect()
    got = sorted(((r.doc_id, normal(r.text)) for r in left), key=str)
    assert got == sorted([(1, "x y"), (1, "other"), (None, "none"), (3, "")], key=str)
    assert all(tuple(r) in rows for r in left)


def test_against_sql(spark):
    got = queries.op7_exact_dedup(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op7_exact_dedup"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
