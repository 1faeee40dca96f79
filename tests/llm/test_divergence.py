from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from plugtide.llm import divergence, queries
from tests.llm.helpers import SF, no_documents, odd_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def plain(rows, least_texts, top):
    """All rows of the audit from (text, lang, source), term by term."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        bag = Counter(terms(text))
        groups[lang or "", source or ""].update(bag)
        held[lang or ""].update(bag.keys())
    kept = {lang: {t for t, n in of.items() if n >= least_texts} for lang, of in held.items()}

    def shares(count, lang):
        total, v = sum(count[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * v) for t in kept[lang]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    own = {g: shares(c, g[0]) for g, c in groups.items()}
    out = []
    for (lang, source), p in own.items():
        whole = Counter()
        for g, c in groups.items():
            if g[0] == lang:
                whole.update(c)
        q = shares(whole, lang)
        pairs = [(-sum(f(p[t], o[t]) for t in p), g[1].encode(), g[1]) for g, o in own.items() if g[0] == lang and g[1] != source]
        found = [(-f(p[t], q[t]), t.encode(), t) for t in p if groups[lang, source][t] > 0 and p[t] > q[t]]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted(found)[:top])):
            out += [(lang, source, part, item, -v, k + 1) for k, (v, _, item) in enumerate(ranked)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def invented(count, sources, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}é" if b == "x" else a + b for a in "abcdefgh" for b in "ijklmnx"]
    rows = []
    for k in range(count):
        lang = rng.choice(["en", "en", "de", None, "none"])
        source = None if k % 11 == 0 else f"s{rng.randrange(sources)}" if k % 3 else "hot"
        words = "" if lang == "none" else " ".join(rng.choices(vocabulary, [1 / (1 + j) for j in range(len(vocabulary))], k=rng.randrange(30)))
        rows.append((None if k % 13 == 0 else words.title() if k % 2 else words, lang, source))
    return rows


@pytest.mark.parametrize("least_texts, top", [(10, 10), (1, 3), (200, 10)])
def test_against_plain_counts(spark, least_texts, top):
    rows = invented(300, 5)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert found(divergence.audit(docs, least_texts=least_texts, top=top)) == plain(rows, least_texts, top)


def test_blocks_of_sources_and_parts_of_terms(spark, monkeypatch):
    for name, value in (("BLOCK", 3), ("PART_ROWS", 20), ("CELLS", 8)):
        monkeypatch.setattr(divergence, name, value)
    rows = invented(300, 8, seed=2)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert found(divergence.audit(docs, least_texts=5)) == plain(rows, 5, 10)


def test_slices_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 1)
    rows = invented(60, 3, seed=3)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(2)
    assert found(divergence.audit(docs, least_texts=3)) == plain(rows, 3, 10)


def test_odd_rows_and_equal_values(spark):
    docs = odd_documents(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert found(divergence.audit(docs, least_texts=1)) == plain(rows, 1, 10)
    ties = [(" ".join(f"t{chr(97 + k)}" for k in range(26)), "en", "a"), ("other", "en", "b")] * 10
    docs = spark.createDataFrame(ties, "text string, lang string, source string")
    assert found(divergence.audit(docs)) == plain(ties, 10, 10)


def test_empty_table(spark):
    got = divergence.audit(no_documents(spark))
    assert got.collect() == [] and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**12, 10**13, 10**9)], "n long, total long, v long")
    assert big.select(divergence.share("n", "total", "v").alias("p")).first().p == 1 + 10**9 * (10**12 + 2) // (10**13 + 2 * 10**9)


def test_against_sql(spark):
    columns = ["item", "lang", "part", "rank", "source", "value"]
    got = queries.op13_divergence_audit(spark, SF).select(columns).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL['op13_divergence_audit']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
