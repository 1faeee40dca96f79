from __future__ import annotations

import glob
import math
import tempfile
import time
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from plugtide.functions.durable import durable
from plugtide.llm import lm
from tests.llm.helpers import ODD_TEXTS, SF, crc, no_documents, odd_documents, words


class Plain:
    """The same model, counted and applied word by word."""

    def __init__(self, rows, folds=5, held=1):
        self.held = lambda i: i is not None and crc(i) % folds == held
        training = [[*words(t), ""] for i, t in rows if not self.held(i)]
        self.c = Counter(w for t in training for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        head = {*self.c, ""}
        self.pairs, self.triples, self.out1, self.out2 = Counter(), Counter(), Counter(), Counter()
        for text in training:
            text = ["", *text]
            self.pairs.update((a, b) for a, b in zip(text, text[1:]) if {a, b} <= head)
            self.triples.update((a, b, c) for a, b, c in zip(text, text[1:], text[2:]) if {a, b, c} <= head)
        for (a, _), c in self.pairs.items():
            self.out1[a] += (c - lm.DISCOUNT) / self.c[a]
        for (a, b, _), c in self.triples.items():
            self.out2[a, b] += (c - lm.DISCOUNT) / self.pairs[a, b]
        self.head = head

    def base(self, w):
        return (self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def probability(self, history, w):
        p, last = self.base(w), history[-1]
        if last in self.head:
            own = (self.pairs[last, w] - lm.DISCOUNT) / self.c[last] if (last, w) in self.pairs else 0.0
            p = own + (1 - self.out1[last]) * p
            two = tuple(history[-2:])
            if len(two) == 2 and two in self.pairs and set(two) <= self.head:
                own = (self.triples[*two, w] - lm.DISCOUNT) / self.pairs[two] if (*two, w) in self.triples else 0.0
                p = own + (1 - self.out2[two]) * p
        return p

    def row(self, i, text):
        tokens = [*words(text), ""]
        path = ["", *tokens]
        return (
            i, self.held(i), len(tokens), sum(w in self.c for w in tokens), self.n,
            sum(math.log10(self.base(w)) for w in tokens),
            sum(math.log10(self.probability(path[:k], path[k])) for k in range(1, len(path))),
        )


def compare(rows, texts):
    plain = Plain(texts)
    want = sorted((plain.row(i, t) for i, t in texts), key=str)
    got = sorted((tuple(r) for r in rows), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("block", [2_500_000, 5_000])
def test_given_documents(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    compare(lm.score_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    compare(lm.score_documents(odd_documents(spark)).collect(), ODD_TEXTS)
    assert lm.score_documents(no_documents(spark)).collect() == []


def test_probabilities_add_up():
    texts = [(i, t) for i, t in enumerate(["a b a b c", "a b c", "b a", "c c a b", "a", "b b b"])]
    plain = Plain(texts)
    for history in (["", "a"], ["", "a", "b"], ["a", "nowhere"], [""]):
        unseen = plain.probability(history, "never met")
        assert sum(plain.probability(history, w) for w in plain.c) + unseen == pytest.approx(1)


def test_every_word_is_a_state_of_the_model(spark):
    """Rare words have pairs and triples as well, however many tokens there are."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compare(lm.score_documents(docs).collect(), rows)


def test_small_blocks_and_parts_agree(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 3_000)
    monkeypatch.setattr(lm, "PART_TOKENS", 2_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    compare(lm.score_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_parcels_come_back_whole():
    arrays = [[0, -1, 1 << 40, -(1 << 63)], [], [7] * 5000, list(range(300))]
    packed = lm._packed(*(lm.np.array(a, lm.np.int64) for a in arrays))
    assert [a.tolist() for a in lm._unpack(packed, 4)] == arrays
    assert len(packed) < 2000


def test_a_block_sends_few_bytes_a_token():
    """Parcels name words by small numbers; with hashes of their words they took some 14 bytes a token."""
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).combine_chunks()
    size, parts, ranges = len(table), 100, 3
    rows = pa.record_batch(
        [
            pa.array([0] * size, pa.int32()), table["doc_id"].combine_chunks(), pa.array([False] * size),
            table["text"].combine_chunks(),
        ],
        ["block", "doc_id", "held_out", "text"],
    )
    parcels = list(lm._parcel(iter([rows])))
    asked = list(lm._ask_words(ranges)(iter(parcels)))
    named = pa.concat_tables(lm._name(ranges)(pa.Table.from_batches([b]).slice(i, 1)) for b in asked for i in range(len(b)))
    named = named.filter(named["answer"].is_valid())
    sent = lm._ask(parts, ranges)((pa.scalar(0),), pa.Table.from_batches(parcels), named)
    tokens = sum(len(words(t)) + 1 for t in table["text"].to_pylist())
    bytes_of = lambda column: sum(len(p.as_py()) for p in column)
    of_words = sum(bytes_of(b.column("parcel")) for b in asked) + bytes_of(named["answer"])
    assert bytes_of(sent["parcel"]) < 5 * tokens and of_words < 3 * tokens


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    """The tables on the way leave no shuffle files behind for the passes that follow."""
    root = spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    files = lambda: set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data"))
    before = files()
    durable(spark.range(1000).repartition(3, "id"), "tidied", tidy=True)
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_words_have_hashes_of_their_own():
    texts = ["", "\0", "\0\0", "a", "a\0", "\0a", "b", "ab", "ba", "\xe9", *map(str, range(20000))]
    assert len(set(lm.hashes(pa.array(texts, pa.large_string())).tolist())) == len(texts)
