"""Token counts of whole texts; huge texts go through the tokenizer in overlapping chunks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.llm.memo import SLICE_BYTES, Memo
from plugtide.llm.words import coded, slices, split_words

# Characters of a chunk, and of the overlap of two chunks at first.
CHUNK = 16_384
OVERLAP = 256
# A place is proven stable where white space ends. The tokenizer drops white space
# before its merges, and neither its normalisation nor its patterns look across it, so on either
# side of such a place the tokens are the same whatever lies on the other side.
STABLE = re.compile(r"(?<=[\x20\t\n\r])(?=[^\s])")


def open_tokenizer(path: str):
    """The tokenizer of a file, on this task's thread alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _word_counts(tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    encoded = tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
    return np.fromiter(map(len, encoded), np.int64, len(words)), np.arange(len(words) + 1)


def count_in_chunks(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text, with no more than a chunk and its overlap encoded at once.

    Two chunks are spliced at a stable place of their overlap where both encodings begin a token:
    the first counts up to it, the second from it on. Without such a place the overlap is doubled
    and the first chunk encoded again, in the end up to the end of the text.
    """
    total, start = 0, 0
    while True:
        end = min(len(text), start + chunk)
        width = overlap
        while True:
            stop = min(len(text), end + width)
            first = tokenizer.encode(text[start:stop], add_special_tokens=False)
            if stop == len(text):
                return total + len(first.ids)
            # The right-hand context is as long as a first overlap, and checks the splice.
            place = _splice(tokenizer, text, first, start, end, stop, overlap)
            if place:
                total += place[1]
                start = place[0]
                break
            width *= 2


def _splice(tokenizer, text: str, first, start: int, end: int, stop: int, overlap: int) -> tuple[int, int] | None:
    """A stable place where the chunk that ends at `stop` and one that begins at `end` agree, and the
    number of the first chunk's tokens before it."""
    second = tokenizer.encode(text[end : stop + overlap], add_special_tokens=False)
    for match in STABLE.finditer(text, end + 1, stop):
        at = match.start()
        left, right = first.char_to_token(at - start), second.char_to_token(at - end)
        if left is None or right is None:
            continue
        if first.token_to_chars(left)[0] == at - start and second.token_to_chars(right)[0] == at - end:
            if first.ids[left] == second.ids[right]:
                return at, left
    return None


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens.

    `path` names a tokenizer file that every executor has. Texts up to `chunk` characters are
    cut at every stable place, and a task encodes each distinct word once; longer ones go through
    the tokenizer in overlapping chunks, so that memory is bounded by the chunk (a text without
    white space is one chunk in the end). Strings of special tokens count as the tokenizer takes
    them by default. A null text is empty and has no tokens; null ids and repeated rows are passed
    on. There is no shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = open_tokenizer(path)
        memo = Memo(lambda words: _word_counts(tokenizer, words), np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = pc.fill_null(batch.column("text"), "")
            huge = pc.greater(pc.utf8_length(texts), chunk)
            words, starts = split_words(pc.if_else(huge, "", texts), lower=False)
            places, distinct = coded(words)
            passed = np.concatenate([[0], np.cumsum(memo(distinct, places)[0])])
            counts = passed[starts[1:]] - passed[starts[:-1]]
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
                counts[i] = count_in_chunks(tokenizer, texts[i].as_py(), chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
