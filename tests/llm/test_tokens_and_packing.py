from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plugtide.llm import packing, queries, tokens
from tests.llm.helpers import LONG, ODD_TEXTS, SF, no_documents, odd_documents

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_tokenizer():
    return tokens.open_tokenizer(WORD)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return tokens.open_tokenizer(BYTE)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(10, 1), (64, 4), (300, 16)])
def test_chunks_splice_to_the_whole(word_tokenizer, chunk, overlap):
    texts = [t for _, t in ODD_TEXTS if t and len(t) < 1000]
    texts += [LONG[:2000], "no-space-at-all" * 40, "É ́x  ΣΑΣ it's\n\n  we'll " * 30, "a" * 500 + " " + "b" * 500]
    for text in texts:
        assert tokens.count_in_chunks(word_tokenizer, text, chunk, overlap) == len(ids_of(word_tokenizer, text))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aÉ's \n\t1.😀́ﬁΣ\x0b　<|endoftext|>", max_size=120))
def test_chunks_of_any_text(text):
    tokenizer = tokens.open_tokenizer(WORD)
    assert tokens.count_in_chunks(tokenizer, text, 12, 2) == len(ids_of(tokenizer, text))


def test_counts_of_documents(spark, word_tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op8_token_counts(spark, SF).collect():
        n = len(ids_of(word_tokenizer, texts[r.doc_id]))
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 2048, len(texts[r.doc_id].encode()))


def test_counts_of_odd_rows(spark, word_tokenizer):
    rows = tokens.count_tokens(odd_documents(spark), WORD).collect()
    want = [(i, len((t or "").encode()), len(ids_of(word_tokenizer, t))) for i, t in ODD_TEXTS]
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want))
    assert tokens.count_tokens(no_documents(spark), WORD).collect() == []


def slow_place(levels, length, size):
    """The rule by its definition: the fill that leaves the least sum of squares, the fullest of equals."""
    best = None
    for fill in range(size - length, -1, -1):
        if fill and not levels.get(fill):
            continue
        after = dict(levels)
        if fill:
            after[fill] -= 1
        if fill + length < size:
            after[fill + length] = after.get(fill + length, 0) + 1
        cost = sum(n * n for n in after.values())
        if best is None or cost < best[0]:
            best = (cost, fill, after)
    return best[1], best[2]


def test_rule_by_its_definition():
    draw, size = np.random.default_rng(1), 40
    rule, levels = packing.SumOfSquares(size), {}
    for length in draw.integers(1, size + 1, 600).tolist():
        fill, levels = slow_place(levels, length, size)
        assert rule.place(length)[1] == fill


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_pieces_fill_windows_without_gaps(lengths):
    pieces = packing.pack(lengths, 16)
    windows = {}
    for length, own in zip(lengths, pieces):
        at = 0
        for start, n, window, offset in own:
            assert start == at and n > 0
            windows.setdefault(window, []).append((offset, n))
            at += n
        assert at == length
    fills = []
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        fills.append(at)
    assert all(f <= 16 for f in fills) and sum(f < 16 for f in fills) <= 1


def check_packing(rows, texts, tokenizer):
    """Rows against a list of (id, text), where ids may repeat."""
    ids = [np.array([*ids_of(tokenizer, t), packing.END], "<u4") for _, t in texts]
    want = sorted((str(i), len(x), zlib.crc32(x[: len(x)].tobytes())) for (i, _), x in zip(texts, ids))
    assert sum(r.length for r in rows) == sum(len(x) for x in ids)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert any(
            str(i) == str(r.doc_id)
            and len(x) == r.doc_tokens
            and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32
            for (i, _), x in zip(texts, ids)
        )
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.WINDOW
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) and want
    # Each id of each document lies in exactly one piece: of documents with one id, as many times as they are.
    covered = {}
    for r in rows:
        own = covered.setdefault((str(r.doc_id), r.doc_tokens), np.zeros(r.doc_tokens, int))
        own[r.start : r.start + r.length] += 1
    wanted = {}
    for i, n, _ in want:
        wanted[i, n] = wanted.get((i, n), 0) + 1
    assert covered.keys() == wanted.keys()
    assert all((own == wanted[key]).all() for key, own in covered.items())


def test_packing_of_documents(spark, byte_tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packing(queries.op10_packing(spark, SF).collect(), texts, byte_tokenizer)


def test_packing_of_odd_rows(spark, byte_tokenizer):
    rows = packing.pack_documents(odd_documents(spark), BYTE, block_docs=4).collect()
    check_packing(rows, ODD_TEXTS, byte_tokenizer)
    assert packing.pack_documents(no_documents(spark), BYTE).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aé's \n\t1.😀 　<|endoftext|>", max_size=60), max_size=8))
def test_encoder_gives_the_tokenizers_ids(texts):
    import pyarrow as pa

    encoder = packing.Encoder(BYTE)
    ids, starts = encoder(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(encoder.tokenizer, text)


def test_words_are_encoded_once_whatever_follows_them():
    import pyarrow as pa

    words, ends = [f"w{c}rd" for c in "abcdeéßœ"], [",", ".\n", "***", "'s", "!\t", ")", "1", "\n\n"]
    texts = [f"to {a}{end}{b}" for a in words for end in ends for b in words]
    encoder = packing.Encoder(BYTE)
    ids, starts = encoder(pa.array(texts))
    assert len(encoder.memo.known) < len(texts) / 2
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(encoder.tokenizer, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZé×÷ßœȿʼс中１Ⅷ²'sldn\n\t\r\x0b\x1c\x7f .,!_(>9…«\u0301\u00a0\u3000😀", max_size=40), max_size=8))
def test_encoder_on_letters_signs_and_white_space(texts):
    import pyarrow as pa

    encoder = packing.Encoder(BYTE)
    texts = texts + [t.replace(" ", "") for t in texts]
    ids, starts = encoder(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(encoder.tokenizer, text)
