from __future__ import annotations

import re

import public_tokenizers

import corpus_pipeline
from plugtide.llm import quality, secrets, tokens
from tests.llm.helpers import SF, near_components, no_documents, odd_documents
from tests.llm.test_secrets import base
from tests.llm.test_tokens_and_packing import check_packing


def test_each_stage_by_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    steps = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    good = steps["quality_classifier"](spark, docs, SF)
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in quality.score(docs, model).collect() if r._quality >= quality.KEEP}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == want

    single = steps["exact_dedup"](spark, good, SF)
    first = {}
    for i in sorted(want):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text or ""), i)
    want = set(first.values())
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == want

    apart = steps["near_dedup"](spark, single, SF)
    named = near_components({i: rows[i].text for i in want}, 5, 80)
    want = {i for i in want if named[i] == i}
    assert apart.columns == docs.columns and {r.doc_id for r in apart.collect()} == want

    hidden = steps["secret_scan"](spark, apart, SF)
    assert hidden.columns == docs.columns
    texts = {}
    for r in hidden.collect():
        expected, at = "", 0
        for start, _, end in base(rows[r.doc_id].text):
            if start >= at:
                expected += rows[r.doc_id].text[at:start] + "[secret]"
            at = max(at, end)
        assert r.text == expected + rows[r.doc_id].text[at:] and r.n_chars == len(r.text)
        texts[r.doc_id] = r.text
    assert set(texts) == want

    packed = corpus_pipeline.run(spark, SF).collect()
    check_packing(packed, list(texts.items()), tokens.open_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, SF)
            assert left.columns == docs.columns
            assert left.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_queries_are_registered():
    import __spark_entry__ as entry

    registered = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in registered) == 1
    assert "pipeline" in registered and secrets.KINDS[-1] == "random"
