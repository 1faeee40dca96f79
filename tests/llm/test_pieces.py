from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from plugtide.llm import pieces, queries
from plugtide.llm.memo import Memo
from tests.llm.helpers import ODD_TEXTS, SF, no_documents, odd_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = pieces.Vocabulary(PATH)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def segment(texts, dropout, seed=1):
    memo = Memo(lambda k: pieces._work(VOCABULARY, k, seed, dropout), np.uint16)
    keys = np.arange(len(texts), dtype=np.int64) + 5
    ids, starts = pieces.segment_texts(pa.array(texts, pa.large_string()), keys, memo, seed)
    data, begins = VOCABULARY.decode(ids, starts)
    decoded = [data[a:b].tobytes().decode() for a, b in zip(begins, begins[1:])]
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])], decoded


TEXTS = ["", " ", "   ", "hello world", "  a  b ", "\n\n x\t", "😀 ﬁne é", "z" * 300, "The " * 50, " " * 40 + "q"]


def test_without_dropout_as_the_models_own_encoder():
    assert segment(TEXTS, 0.0)[0] == MODEL.encode(TEXTS)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6), st.sampled_from([0.0, 0.3, 1.0]))
def test_every_text_comes_back(texts, dropout):
    ids, decoded = segment(texts, dropout)
    assert decoded == texts
    if dropout == 0.0 and not any(pieces.SPACE in t for t in texts):
        assert ids == MODEL.encode(texts)


def slow_segment(unit, key, dropout):
    """The agenda for one unit: the best merge first, the leftmost of equals, skipped ones never again."""
    spans = [(i, i + 1) for i in range(len(unit))]
    names = {MODEL.id_to_piece(i): i for i in range(259, MODEL.get_piece_size())}
    text = unit.replace(" ", pieces.SPACE)
    skipped = set()
    while True:
        best = None
        for n in range(len(spans) - 1):
            (a, b), (_, c) = spans[n], spans[n + 1]
            if text[a:c] not in names or (a, b, c) in skipped:
                continue
            span = np.array([(a << 42) + (b << 21) + c], np.uint64)
            if dropout and pieces.mixed(key ^ pieces.mixed(span))[0] < np.uint64(int(dropout * 2.0**64)):
                skipped.add((a, b, c))
                continue
            rank = VOCABULARY.rank[names[text[a:c]]]
            if best is None or rank < best[0]:
                best = (rank, n)
        if best is None:
            return [names[text[a:b]] for a, b in spans]
        spans[best[1] : best[1] + 2] = [(spans[best[1]][0], spans[best[1] + 1][1])]


@pytest.mark.parametrize("dropout", [0.0, 0.2, 0.5])
def test_agenda_step_by_step(dropout):
    units = [" hello", " segmentation", " unbelievable", "   indent", " a", " internationalisation", " the"]
    variants = np.arange(len(units)) % pieces.VARIANTS
    import zlib

    keys = np.array([zlib.crc32(u.encode()) for u in units], np.uint64)
    keys = pieces.mixed(keys * np.uint64(pieces.VARIANTS * 1024) + variants.astype(np.uint64) + pieces.mixed(np.array([9]))[0])
    ids, starts = VOCABULARY.segment(pa.array(units, pa.large_string()), variants, 9, dropout)
    for i, unit in enumerate(units):
        assert ids[starts[i] : starts[i + 1]].tolist() == slow_segment(unit, keys[i : i + 1], dropout)


def test_seeds_vary_segmentations_and_repeat():
    texts = ["varied segmentation of internationalised documents"] * 20
    one, again, other = segment(texts, 0.3)[0], segment(texts, 0.3)[0], segment(texts, 0.3, seed=2)[0]
    assert one == again and one != other and len({tuple(x) for x in one}) > 3


def test_odd_rows(spark):
    rows = pieces.segment_documents(odd_documents(spark), PATH).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD_TEXTS)
    assert all(r.lossless for r in rows) and sum(not r.ids for r in rows) == 3
    assert pieces.segment_documents(no_documents(spark), PATH).collect() == []


def test_given_documents(spark):
    rows = queries.op6_merge_dropout(spark, SF).collect()
    assert len(rows) == 200 and all(r.lossless and r.n_pieces == len(r.ids) for r in rows)


def test_merges_are_skipped_per_occurrence():
    """Each occurrence of a frequent unit is drawn for itself, and as its own key says."""
    count, dropout = 4000, 0.1
    keys = pieces.mixed(np.arange(count))
    memo = Memo(lambda k: pieces._work(VOCABULARY, k, 1, dropout), np.uint16)
    for unit in (" the", " documents", " internationalisation", " " + "long" * 40):
        units = pa.array([unit], pa.large_string())
        ids, starts = pieces._segmented(units, np.zeros(count, np.int64), keys, memo)
        got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
        for i in range(0, count, 100):
            assert got[i] == slow_segment(unit, keys[i : i + 1], dropout)
        whole, begins = VOCABULARY.segment_keyed(pa.array([unit] * count, pa.large_string()), keys, dropout)[0]
        assert got == [whole[a:b].tolist() for a, b in zip(begins, begins[1:])]
        (plain, _), (spans, _) = VOCABULARY.segment_keyed(units, keys[:1], 0.0)
        # Other merges may lead to the same ids.
        share = sum(g == plain.tolist() for g in got) / count
        assert (1 - dropout) ** len(spans) - 0.03 < share < 0.95
        assert len({tuple(g) for g in got}) > (1 if unit == " the" else pieces.VARIANTS)


def test_a_merge_touches_its_neighbours_only(monkeypatch):
    """A step moves no letters, and looks a few places up for each unit however long the units are."""
    looked_up = []
    merge = pieces.Vocabulary.merge
    monkeypatch.setattr(pieces.Vocabulary, "merge", lambda self, a, b: looked_up.append(len(a)) or merge(self, a, b))
    monkeypatch.setattr(np, "take_along_axis", lambda *_, **__: pytest.fail("letters are moved"))
    units = pa.array([" " + "internationalisation" * 3, " the"] * 50, pa.large_string())
    keys = np.arange(100, dtype=np.uint64)
    (ids, starts), (spans, _) = VOCABULARY.segment_keyed(units, keys, 0.3)
    for k in range(4):
        assert ids[starts[k] : starts[k + 1]].tolist() == slow_segment(units[k].as_py(), keys[k : k + 1], 0.3)
    assert sum(looked_up) <= sum(map(len, units.to_pylist())) + 2 * len(spans)


def test_every_pair_has_its_slot():
    slots = np.flatnonzero(VOCABULARY.pairs >= 0)
    left, right = VOCABULARY.pairs[slots] >> 16, VOCABULARY.pairs[slots] & 0xFFFF
    assert (VOCABULARY.merge(left, right) == VOCABULARY.merged[slots]).all()
    assert VOCABULARY.merge(np.array([-1, -5, 7]), np.array([3, 3, -1])).tolist() == [-1, -1, -1]
    assert 2 * len(slots) <= len(VOCABULARY.pairs)
