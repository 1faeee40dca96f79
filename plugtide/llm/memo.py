"""Results per distinct string that a task remembers from one slice of its rows to the next."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plugtide.llm.words import gather

# Text handled at once: every slice looks all its distinct strings up.
SLICE_BYTES = 4 << 20
# Distinct strings remembered; beyond that a task starts afresh.
REMEMBERED = 800_000


class Memo:
    """Ragged results of a function of strings, worked out once per distinct string.

    `work` takes a list of strings and returns all results in one array, and where each string's
    begin and the last one's end.
    """

    def __init__(self, work: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], kind=np.uint32):
        self.work, self.kind = work, kind
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.values = np.zeros(0, self.kind)
        self.starts = np.zeros(1, np.int64)

    def __call__(self, distinct: pa.Array, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The results of `distinct[places]`, one after the other, and where they begin."""
        at = pc.index_in(distinct, self.known)
        new = pc.is_null(at)
        count = pc.sum(new).as_py() or 0
        if count and len(self.known) and len(self.known) + count > REMEMBERED:
            self._forget()
            return self(distinct, places)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if count:
            added = distinct.filter(new)
            values, starts = self.work(added)
            new = new.to_numpy(zero_copy_only=False)
            at = np.where(new, len(self.known) + np.cumsum(new) - 1, at)
            self.known = pa.concat_arrays([self.known, added])
            self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
            self.values = np.concatenate([self.values, values.astype(self.kind, copy=False)])
        return gather(self.values, self.starts, at[places])
