"""Text columns cut into terms inside a task: runs of letters or of letters and digits, A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from plugtide.llm.words import lowered, raw, strings

_ASCII = np.arange(256)
_LETTERS = ((_ASCII >= 65) & (_ASCII <= 90)) | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
# Which bytes of UTF-8 belong to a term: letters and all signs beyond ASCII; these and digits.
LETTERS = _LETTERS
LETTERS_AND_DIGITS = _LETTERS | ((_ASCII >= 48) & (_ASCII <= 57))


def split_terms(texts: pa.Array, members: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All maximal runs of `members` in order, and where each text's begin and the last one's end.

    A null text has none.
    """
    data, starts = raw(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(starts), np.int64)
    inside = members[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = starts[:-1][starts[:-1] < starts[1:]]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    passed = np.cumsum(inside, dtype=np.int64)
    offsets = np.append(passed[at] - 1, passed[-1])
    return strings(lowered(data[inside]), offsets), np.searchsorted(at, starts)
