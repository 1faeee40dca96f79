"""Documents packed into sequences of a fixed number of tokens, by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.llm.memo import SLICE_BYTES, Memo
from plugtide.llm.tokens import open_tokenizer
from plugtide.llm.words import coded, gather, raw, slices, strings

WINDOW = 2048
END = 1
# Documents packed together, on average.
BLOCK_DOCS = 2048
# Distinct parts of text given to the tokenizer at once.
JOINED = 2000
# Where spaces touch other white space, the tokenizer joins them into one run.
RUNS = r"[\x20\t\n\r\x0B\x0C\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# White space that may begin a part, bytes of ASCII letters, other signs of ASCII that are no white space.
SPACES = " \t\n\r"
_ASCII = np.arange(256)
_BLANK = np.isin(_ASCII, [ord(c) for c in SPACES])
_LETTER = ((_ASCII >= 65) & (_ASCII <= 90)) | ((_ASCII >= 97) & (_ASCII <= 122))
_SIGN = (_ASCII > 32) & (_ASCII < 127) & ~_LETTER


def cut_places(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 begin a part that a tokenizer with the byte-level pattern takes by itself.

    Those are each space; each tab and end of a line after a sign that is no white space; and each other sign of ASCII
    after a letter, where a run of letters ends whatever follows. Letters are those of ASCII and U+00C0 to U+023F.
    """
    cuts = data == 32
    letter = _LETTER[data]
    for lead in range(0xC3, 0xC9):
        at = np.flatnonzero(data[:-1] == lead) + 1
        if lead == 0xC3:
            at = at[(data[at] != 0x97) & (data[at] != 0xB7)]
        letter[at] = True
    sign = _SIGN[data]
    cuts[1:] |= (letter[:-1] | sign[:-1]) & _BLANK[data[1:]] | letter[:-1] & sign[1:]
    return cuts


class Encoder:
    """Ids of whole texts by a byte-level tokenizer that puts a single space before the word it precedes.

    A text in which no space touches other white space is the same to the tokenizer as its parts
    cut at `cut_places` (before each space only, where its pattern is not the byte-level one), so every
    distinct part is encoded once and remembered. Other texts, and those with a special token's string,
    are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = open_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pattern = self.tokenizer.pre_tokenizer
        self.finely = self.tokenizer.normalizer is None and isinstance(pattern, ByteLevel) and pattern.use_regex
        size = self.tokenizer.get_vocab_size()
        # Each character of a token's name stands for one byte.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)], np.int64)
        self.memo = Memo(self._parts)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), starts

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct parts.

        Parts that begin with white space and end without it are encoded many at a time, one after
        the other; the bytes of the tokens tell where each part's end.
        """
        texts = parts.to_pylist()
        alone = np.fromiter((t[0] not in SPACES or t[-1].isspace() for t in texts), bool, len(texts))
        single, single_starts = self._encode([texts[i] for i in np.flatnonzero(alone)])
        rest = [texts[i] for i in np.flatnonzero(~alone)]
        joined, _ = self._encode(["".join(rest[i : i + JOINED]) for i in range(0, len(rest), JOINED)])
        ends = np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False)[~alone])
        passed = np.concatenate([[0], np.cumsum(self.bytes_of[joined])])
        joined_starts = np.searchsorted(passed, np.concatenate([[0], ends]))
        order = np.where(alone, np.cumsum(alone) - 1, len(single_starts) - 1 + np.cumsum(~alone) - 1)
        starts = np.concatenate([single_starts, single_starts[-1] + joined_starts[1:]])
        return gather(np.concatenate([single, joined]), starts, order)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's begin and the last one's end."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, f"{RUNS}\\x20|\\x20{RUNS}")
        for content in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        data, starts = raw(pc.if_else(odd, "", texts))
        odd = odd.to_numpy(zero_copy_only=False)
        ids, id_starts = np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        if len(data):
            cuts = cut_places(data) if self.finely else data == 32
            cuts[starts[:-1][starts[:-1] < len(data)]] = True
            at = np.flatnonzero(cuts)
            places, parts = coded(strings(data, np.append(at, len(data))))
            ids, part_starts = self.memo(parts, places)
            id_starts = part_starts[np.searchsorted(at, starts)]
        if not odd.any():
            return ids, id_starts
        whole, whole_starts = self._encode(texts.filter(pa.array(odd)).to_pylist())
        rows = np.where(odd, len(odd) + np.cumsum(odd) - 1, np.arange(len(odd)))
        return gather(np.concatenate([ids, whole]), np.concatenate([id_starts, id_starts[-1] + whole_starts[1:]]), rows)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class SumOfSquares:
    """Online packing: a document goes where the squared counts of windows by fill stay least.

    `levels[h]` counts the windows filled to h. Moving one from h to h + s changes the sum of squares
    by 2 (levels[h + s] - levels[h]) + 2; a full window leaves the array. Ties go to the fullest.
    """

    def __init__(self, size: int):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """The window and the offset in it for a piece of at most a window."""
        last = self.size - length
        now = self.levels[: last + 1]
        change = 2 * (self.levels[length:] - now) + 2
        change[last] = 1 - 2 * now[last]
        if last:
            change[0] = 2 * self.levels[length] + 1
        else:
            change[0] = 0
        change[1:] = np.where(now[1:] > 0, change[1:], np.iinfo(np.int64).max)
        fill = last - int(np.argmin(change[::-1]))
        if fill:
            window = self.windows[fill].pop()
            self.levels[fill] -= 1
        else:
            window = self.opened
            self.opened += 1
        if fill + length < self.size:
            self.windows[fill + length].append(window)
            self.levels[fill + length] += 1
        return window, fill

    def open_windows(self) -> list[tuple[int, int]]:
        """(fill, window) of those partly filled, the fullest first."""
        return [(fill, w) for fill in range(self.size - 1, 0, -1) for w in self.windows[fill]]


def pack(lengths: list[int], size: int = WINDOW) -> list[list[tuple[int, int, int, int]]]:
    """Per document, in the order given: its pieces as (start, length, window, offset).

    Whole windows are cut off the front of a document; the rest is placed by the sum-of-squares
    rule. At the end, the windows still partly filled are closed: the fullest is filled up with
    pieces cut from the emptiest, so that at most one window stays with padding.
    """
    rule = SumOfSquares(size)
    pieces: list[list[tuple[int, int, int, int]]] = []
    inside: dict[int, list[tuple[int, int, int]]] = {}
    for number, length in enumerate(lengths):
        cut = length // size * size
        own = []
        for start in range(0, cut, size):
            own.append((start, size, rule.opened, 0))
            rule.opened += 1
        if length > cut:
            window, offset = rule.place(length - cut)
            inside.setdefault(window, []).append((number, cut, length - cut))
            own.append((cut, length - cut, window, offset))
        pieces.append(own)

    waiting = rule.open_windows()
    if len(waiting) < 2:
        return pieces
    reopened = {w for _, w in waiting}
    moved: dict[int, list[tuple[int, int, int, int]]] = {}
    front, back = 0, len(waiting) - 1
    rest = list(reversed(inside[waiting[back][1]]))
    while front < back:
        fill, window = waiting[front]
        while fill < size and front < back:
            number, start, length = rest.pop()
            take = min(length, size - fill)
            moved.setdefault(number, []).append((start, take, window, fill))
            fill += take
            if take < length:
                rest.append((number, start + take, length - take))
            if not rest:
                back -= 1
                if front < back:
                    rest = list(reversed(inside[waiting[back][1]]))
        offset = 0
        for number, start, length in inside[window]:
            moved.setdefault(number, []).append((start, length, window, offset))
            offset += length
        front += 1
    if front == back:
        window, offset = waiting[back][1], 0
        for number, start, length in reversed(rest):
            moved.setdefault(number, []).append((start, length, window, offset))
            offset += length
    for number, parts in moved.items():
        pieces[number] = sorted([p for p in pieces[number] if p[2] not in reopened] + parts)
    return pieces


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    end: int = END,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Documents are dealt by a hash of id and text into blocks of `block_docs` on average, and each
    block is packed for itself, in the order of ids, so the result does not depend on tasks. Whole
    windows are cut off and checked where the text is read; only the rest of each document, less
    than a window, goes through the shuffle. A null text is empty: one piece with the end id. Rows
    that repeat are documents of their own. An empty table gives no piece.
    """
    blocks = max(1, -(-docs.count() // block_docs))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, starts = encoder(batch.column("text"))
            lengths, sums, rests = [], [], []
            for a, b in zip(starts[:-1], starts[1:]):
                own = np.append(ids[a:b], np.uint32(end))
                cut = len(own) // size * size
                lengths.append(len(own))
                sums.append([crc32(own[i : i + size]) for i in range(0, cut, size)])
                rests.append(own[cut:].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("block"),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.list_(pa.int64())),
                    pa.array(rests, pa.binary()),
                ],
                ["doc_id", "block", "tokens", "sums", "rest"],
            )

    def pack_block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("tokens", "ascending"), ("rest", "ascending")])
        lengths, sums = table["tokens"].to_pylist(), table["sums"].to_pylist()
        block, rests = table["block"][0].as_py(), table["rest"].to_pylist()
        row, columns = [], {c: [] for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        for number, pieces in enumerate(pack(lengths, size)):
            cut, rest = len(sums[number]) * size, np.frombuffer(rests[number], "<u4")
            for start, length, window, offset in pieces:
                row.append(number)
                columns["start"].append(start)
                columns["length"].append(length)
                columns["ids_crc32"].append(
                    sums[number][start // size] if start < cut else crc32(rest[start - cut : start - cut + length])
                )
                columns["doc_tokens"].append(lengths[number])
                columns["sequence_id"].append((block << 32) + window)
                columns["offset"].append(offset)
        ids = table["doc_id"].take(pa.array(row, pa.int64()))
        return pa.table({"doc_id": ids} | {c: pa.array(v, pa.int64()) for c, v in columns.items()})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    encoded = rows.mapInArrow(encode, f"doc_id {kind}, block long, tokens long, sums array<long>, rest binary")
    numbers = ", ".join(f"{c} long" for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    return encoded.groupBy("block").applyInArrow(pack_block, f"doc_id {kind}, {numbers}")
