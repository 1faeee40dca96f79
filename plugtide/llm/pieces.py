"""Varied segmentations into word pieces by seeded merge dropout, and their decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.llm.memo import SLICE_BYTES, Memo
from plugtide.llm.words import coded, gather, mixed, raw, slices, strings

SEED = 17
DROPOUT = 0.1
# Numbered variants that the keys of `Vocabulary.segment` leave room for; texts do not use them.
VARIANTS = 4
# Letters of a unit up to which its merges are remembered; each occurrence of a longer one is worked
# out for itself.
REMEMBERED_LETTERS = 64
SPACE = "▁"
# Rows of equal width are merged together; the widest are handled alone.
WIDTHS = [4, 8, 12, 16, 24, 32, 64, 128, 512, 4096]


class Vocabulary:
    """The pieces and merges of a model file whose pieces are merged by score, with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        surfaces = [b"" if s else p.replace(SPACE, " ").encode() for p, s in zip(names, special)]
        for b, i in enumerate(self.bytes):
            surfaces[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_starts = np.concatenate([[0], np.cumsum([len(s) for s in surfaces])]).astype(np.int64)

        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.never = np.int64(self.rank.max() + 1)
        merges = {
            (ids[p[:k]] << 16) + ids[p[k:]]: i
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        }
        self._place(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int64))
        single = {ord(p): i for p, i in ids.items() if len(p) == 1 and p != SPACE}
        self.letter = np.full(0x110000, -1, np.int64)
        self.letter[list(single)] = list(single.values())
        self.letter[0x20] = ids[SPACE]

    def _place(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        """A hash table of pairs: each stands in its own slot or in the next free one; half of the slots at least are free."""
        self.bits = max(4, int(2 * len(pairs)).bit_length() + 1)
        self.pairs = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            free = np.flatnonzero(self.pairs[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.pairs[taken], self.merged[taken] = pairs[left[placed]], merged[left[placed]]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two neighbours make, or -1."""
        made = np.full(len(left), -1)
        rest = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[rest] << 16) + right[rest]
        slot = self._slot(key)
        while len(rest):
            found = self.pairs[slot]
            same = found == key
            made[rest[same]] = self.merged[slot[same]]
            on = np.flatnonzero(~same & (found >= 0))
            rest, key, slot = rest[on], key[on], (slot[on] + 1) & (len(self.pairs) - 1)
        return made

    def segment(
        self, units: pa.Array, variants: np.ndarray, seed: int, dropout: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each unit in its variant, and where they begin.

        All units of about the same length go through the agenda together: in each step every unit
        takes its best merge, the leftmost of equals. A merge is a span and the place in it where
        its parts meet; it is skipped for good when the hash of seed, variant, unit and these three
        places falls below `dropout`.
        """
        text = units.to_pylist()
        keys = np.fromiter((zlib.crc32(t.encode()) for t in text), np.uint64, len(text))
        keys = mixed(keys * np.uint64(VARIANTS * 1024) + variants.astype(np.uint64) + mixed(np.array([seed]))[0])
        return self.segment_keyed(units, keys, dropout)[0]

    def segment_keyed(
        self, units: pa.Array, keys: np.ndarray, dropout: float, without: np.ndarray | None = None
    ) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """As `segment`, with the units' keys: the ids and where they begin; and the spans merged, in order.

        `without` has a span per unit that is skipped, whatever its hash.
        """
        text = units.to_pylist()
        letters = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, text), np.int64, len(text)))])
        lengths = np.diff(starts)
        order: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        merged: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        counts = np.zeros(len(text), np.int64)
        for low, high in zip([0, *WIDTHS], [*WIDTHS, int(max(lengths.max(initial=0), WIDTHS[-1])) + 1]):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            step = max(1, (1 << 20) // max(1, high))
            for some in (rows[i : i + step] for i in range(0, len(rows), step)):
                gone = None if without is None else without[some]
                own, own_starts, spans = self._merged(letters, starts, some, keys[some], dropout, gone)
                merged += [(some[live], span) for live, span in spans]
                counts[some] = np.diff(own_starts)
                order.append(some)
                ids.append(own)
        rows, spans = (np.concatenate(x) for x in zip(*merged))
        spans = spans[np.argsort(rows, kind="stable")]
        span_starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(text)))])
        if not order:
            return (np.zeros(0, np.int64), np.zeros(len(text) + 1, np.int64)), (spans, span_starts)
        sequence, values = np.concatenate(order), np.concatenate(ids)
        begins = np.concatenate([[0], np.cumsum(counts[sequence])])
        back = np.empty(len(text), np.int64)
        back[:] = -1
        back[sequence] = np.arange(len(sequence))
        begins = np.append(begins, begins[-1])
        back[back < 0] = len(sequence)
        return gather(values, begins, back), (spans, span_starts)

    def _merged(self, letters, starts, rows, keys, dropout, without):
        lengths = (starts[1:] - starts[:-1])[rows]
        # Past the end stand two places without a letter.
        width = int(lengths.max()) + 2
        columns = np.arange(width)
        inside = columns < lengths[:, None]
        codes = letters[(starts[rows][:, None] + columns)[inside]]
        # Letters without a piece stay apart as -2 - code point; places past the end are -1.
        symbols = np.full(len(rows) * width, -1)
        every = np.flatnonzero(inside)
        known = self.letter[codes]
        symbols[every] = np.where(known >= 0, known, -2 - codes)
        # Nothing is moved when two pieces merge: each place names its neighbours.
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        after[-1] = len(symbols) - 1
        level = np.uint64(_level(dropout))

        def candidates(at):
            """The piece made at places `at`, and its rank in the agenda."""
            middle = after[at]
            made = self.merge(symbols[at], symbols[middle])
            if dropout > 0 or without is not None:
                some = np.flatnonzero(made >= 0)
                which = at[some] // width
                first = which * width
                span = _span(at[some] - first, middle[some] - first, after[middle[some]] - first)
                skipped = np.zeros(len(some), bool)
                if without is not None:
                    skipped |= span == without[which]
                if dropout > 0:
                    skipped |= mixed(keys[which] ^ mixed(span)) < level
                made[some[skipped]] = -1
            return made, np.where(made >= 0, self.rank[made], self.never)

        made = np.full(len(symbols), -1)
        rank = np.full(len(symbols), self.never)
        made[every], rank[every] = candidates(every)
        rank = rank.reshape(-1, width)
        live = np.arange(len(rows))
        spans = []
        while True:
            best = np.argmin(rank, axis=1)
            going = np.flatnonzero(rank[np.arange(len(rank)), best] < self.never)
            if not len(going):
                break
            best = best[going]
            if 4 * len(going) < 3 * len(rank):
                rank, live, going = rank[going], live[going], np.arange(len(going))
            first = live[going] * width
            at = first + best
            middle = after[at]
            end = after[middle]
            spans.append((live[going], _span(best, middle - first, end - first)))
            symbols[at], symbols[middle] = made[at], -1
            after[at], before[end] = end, at
            rank[going, middle - first] = self.never
            # The merged piece and the one before it have new neighbours.
            led = np.flatnonzero(best > 0)
            changed = np.concatenate([at, before[at[led]]])
            made[changed], ranks = candidates(changed)
            rank[np.concatenate([going, going[led]]), changed - np.concatenate([first, first[led]])] = ranks
        symbols = symbols.reshape(-1, width)
        present = symbols != -1
        flat, counts = symbols[present], present.sum(axis=1)
        unknown = np.flatnonzero(flat < 0)
        if len(unknown):
            flat, counts = self._with_bytes(flat, counts, unknown)
        return flat, np.concatenate([[0], np.cumsum(counts)]), spans

    def _with_bytes(self, flat, counts, unknown):
        """Letters without a piece become the pieces of their bytes."""
        parts = [chr(-2 - c).encode("utf-8", "surrogatepass") for c in flat[unknown].tolist()]
        widths = np.ones(len(flat), np.int64)
        widths[unknown] = [len(p) for p in parts]
        spread = np.repeat(flat, widths)
        ends = np.cumsum(widths)
        for i, part in zip(unknown, parts):
            spread[ends[i] - len(part) : ends[i]] = self.bytes[list(part)]
        rows = np.repeat(np.arange(len(counts)), counts)
        return spread, np.bincount(rows, widths, len(counts)).astype(np.int64)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each row of ids, without the space put before a text, and where they begin."""
        data, piece_starts = gather(self.surface, self.surface_starts, ids)
        begins = piece_starts[starts]
        full = begins[1:] > begins[:-1]
        keep = np.ones(len(data), bool)
        keep[begins[:-1][full]] = False
        passed = np.concatenate([[0], np.cumsum(keep)])
        return data[keep], passed[begins]


def _span(begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The span of a merge and the place in it where its parts meet, as one number."""
    begin, middle, end = (x.astype(np.uint64) for x in (begin, middle, end))
    return (begin << np.uint64(42)) + (middle << np.uint64(21)) + end


def _level(dropout: float) -> int:
    """A merge whose hash lies below this is skipped."""
    return min(int(dropout * 2.0**64), 2**64 - 1)


def segment_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    dropout: float = DROPOUT,
) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (array of int), lossless.

    A space is put before a text, as the model's own encoder does, and the text is cut into units:
    spaces and what follows them up to the next space. No piece spans two units, so each is merged
    for itself. In every occurrence of a unit each merge is skipped or not for itself, by a hash of
    seed, id, the unit's number in its document and the merge's span. A task remembers the merges of
    each unit with none skipped, and with one of these skipped; an occurrence that skips none of the
    merges so found has that result, and any other one is worked out for itself. Without dropout the ids are those of the model's own encoder, but for the character that
    stands for a space inside the model: as part of a text it is spelled in bytes, so that decoding
    gives every text back. `lossless` says that it did. Null and empty texts have no ids; with a
    null id the text's length takes the id's place. There is no shuffle.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        memo = Memo(lambda keyed: _work(vocabulary, keyed, seed, dropout), np.uint16)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
            ids, starts = segment_texts(texts, batch.column("key").to_numpy(), memo, seed)
            data, begins = vocabulary.decode(ids, starts)
            given, places = raw(texts)
            same = np.diff(begins) == np.diff(places)
            if same.all():
                wrong = np.concatenate([[0], np.cumsum(data != given)])
                same = wrong[places[1:]] == wrong[places[:-1]]
            else:
                edges = zip(begins, begins[1:], places, places[1:])
                same = np.array([data[a:b].tobytes() == given[c:d].tobytes() for a, b, c, d in edges])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32))),
                    pa.array(same),
                ],
                ["doc_id", "ids", "lossless"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.length("text").cast("string"), F.lit("")))
    return rows.withColumn("key", key).mapInArrow(segment, f"doc_id {kind}, ids array<int>, lossless boolean")


def _work(vocabulary: Vocabulary, keyed: pa.Array, seed: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Segments units that carry in front what is skipped; all of a call carry the same kind.

    * "0": nothing, and "1" with three letters: the span that they spell. The result is the number of
      merges, three numbers for each, and the ids.
    * "k" with 16 digits: what the hashes with this key say. The result is the ids.
    * An empty unit asks for the level of the hashes, as four numbers of 16 bits.
    """
    kind = keyed[0].as_py()[:1] if len(keyed) else "k"
    if not kind:
        return np.array([_level(dropout)], "<u8").view("<u2").astype(np.int64), np.array([0, 4])
    if kind == "k":
        digits = "".join(pc.utf8_slice_codeunits(keyed, 1, 17).to_pylist())
        keys = np.frombuffer(bytes.fromhex(digits), ">u8").astype(np.uint64)
        return vocabulary.segment_keyed(pc.utf8_slice_codeunits(keyed, 17), keys, dropout)[0]
    without = None
    if kind == "1":
        spelled = "".join(pc.utf8_slice_codeunits(keyed, 1, 4).to_pylist()).encode("ascii")
        without = _span(*(np.frombuffer(spelled, np.uint8).reshape(-1, 3).T - 32))
    units = pc.utf8_slice_codeunits(keyed, 4 if kind == "1" else 1)
    (ids, starts), (spans, span_starts) = vocabulary.segment_keyed(units, np.zeros(len(units), np.uint64), 0.0, without)
    merges = np.diff(span_starts)
    begins = np.concatenate([[0], np.cumsum(1 + 3 * merges + np.diff(starts))])
    values = np.empty(begins[-1], np.int64)
    values[begins[:-1]] = merges
    at = np.arange(len(spans)) * 3 + np.repeat(begins[:-1] + 1 - 3 * span_starts[:-1], merges)
    for i, shift in enumerate((42, 21, 0)):
        values[at + i] = (spans >> np.uint64(shift)) & np.uint64((1 << 21) - 1)
    values[np.arange(len(ids)) + np.repeat(begins[1:] - starts[1:], np.diff(starts))] = ids
    return values, begins


def _looked_up(memo: Memo, keyed: pa.Array):
    """The merges of each unit as spans, and its ids; both with where they begin."""
    values, begins = memo(keyed, np.arange(len(keyed)))
    values = values.astype(np.int64)
    merges = values[begins[:-1]] if len(keyed) else np.zeros(0, np.int64)
    inner = np.repeat(begins[:-1] + 1 + 3 * merges, np.diff(begins)) <= np.arange(len(values))
    head = np.zeros(len(values), bool)
    head[begins[:-1]] = True
    spans = _span(*values[~inner & ~head].reshape(-1, 3).T)
    starts = np.concatenate([[0], np.cumsum(merges)])
    return spans, starts, values[inner], begins - np.arange(len(begins)) - 3 * starts


def _first_skipped(spans: np.ndarray, starts: np.ndarray, places: np.ndarray, keys: np.ndarray, level: int):
    """The occurrences (unit and key) that skip one of the unit's merges, and the first such span."""
    if not level:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own, begins = gather(np.arange(len(spans)), starts, places)
    row = np.repeat(np.arange(len(places)), np.diff(begins))
    at = np.flatnonzero(mixed(keys[row] ^ mixed(spans)[own]) < np.uint64(level))
    rows, first = np.unique(row[at], return_index=True)
    return rows, spans[own[at[first]]]


def _segmented(units: pa.Array, places: np.ndarray, keys: np.ndarray, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the occurrences `units[places]` under their keys, one after the other, and where they begin."""
    nothing = pa.scalar("", pa.large_string())
    joined = lambda *parts: pc.binary_join_element_wise(*parts, nothing)
    level = int(memo.work(pa.array([""], pa.large_string()))[0].astype("<u2").view("<u8")[0])
    short = pc.less_equal(pc.utf8_length(units), REMEMBERED_LETTERS).to_numpy(zero_copy_only=False)
    number = np.cumsum(short) - 1
    result = np.full(len(places), -1)
    open_rows = np.flatnonzero(short[places])
    alone = [np.flatnonzero(~short[places])]

    spans, starts, ids, ends = _looked_up(memo, joined(pa.scalar("0", pa.large_string()), units.filter(pa.array(short))))
    own = number[places[open_rows]]
    result[open_rows] = own
    rows, skipped = _first_skipped(spans, starts, own, keys[open_rows], level)
    open_rows = open_rows[rows]
    parts = [(ids, ends)]
    if len(rows):
        # Spans of short units are told apart by 7 bits for each of the three places.
        seven = np.uint64(127)
        code = sum(((skipped >> np.uint64(s)) & seven) << np.uint64(t) for s, t in ((42, 14), (21, 7), (0, 0)))
        pairs, which = np.unique((places[open_rows] << 21) + code.astype(np.int64), return_inverse=True)
        spelled = np.stack([(pairs >> t) & 127 for t in (14, 7, 0)], axis=1).astype(np.uint8) + 32
        spelled = strings(np.ascontiguousarray(spelled).ravel(), np.arange(len(pairs) + 1) * 3)
        keyed = joined(pa.scalar("1", pa.large_string()), spelled, units.take(pa.array(pairs >> 21)))
        spans, starts, ids, ends = _looked_up(memo, keyed)
        result[open_rows] = len(parts[0][1]) - 1 + which
        parts.append((ids, ends))
        rows, _ = _first_skipped(spans, starts, which, keys[open_rows], level)
        alone.append(open_rows[rows])
    rows = np.concatenate(alone)
    if len(rows):
        digits = np.frombuffer(keys[rows].astype(">u8").tobytes().hex().encode(), np.uint8)
        digits = strings(digits, np.arange(len(rows) + 1) * 16)
        result[rows] = sum(len(e) - 1 for _, e in parts) + np.arange(len(rows))
        parts.append(memo.work(joined(pa.scalar("k", pa.large_string()), digits, units.take(pa.array(places[rows])))))
    sizes = np.concatenate([np.diff(e) for _, e in parts])
    return gather(np.concatenate([i for i, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]), result)


def segment_texts(texts: pa.Array, keys: np.ndarray, memo: Memo, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where each text's begin and the last one's end."""
    space, nothing = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
    spaced = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(space, texts, nothing))
    data, starts = raw(spaced)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    cuts = data == 32
    cuts[1:] &= data[:-1] != 32
    cuts[starts[:-1][starts[:-1] < starts[1:]]] = True
    at = np.flatnonzero(cuts)
    places, units = coded(strings(data, np.append(at, len(data))))
    first = np.searchsorted(at, starts)
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    number = np.arange(len(at)) - first[:-1][rows]
    occurrence = mixed(keys.view(np.uint64)[rows] ^ mixed(number + (seed << 32)))
    ids, unit_starts = _segmented(units, places, occurrence, memo)
    return ids.astype(np.int64), unit_starts[first]
