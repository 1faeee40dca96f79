"""Scores of texts under a backoff n-gram model, read off a weighted automaton."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plugtide.functions.durable import durable
from plugtide.llm.words import SLICE_BYTES, coded, mixed, raw, slices, split_words

# The word that ends a text; no word of a text is empty.
END = ""
# Taken off each n-gram's count and given to the shorter context.
DISCOUNT = 0.75
# Tokens scored in one task at once, on average, tokens whose n-grams are summed at once, and text
# read at once.
BLOCK_TOKENS = 1_000_000
PART_TOKENS = 1_000_000
COUNTED_BYTES = 3 << 20
# Blocks whose words are named in one task, on average: the words of so many blocks are a range.
NAMED_BLOCKS = 4
# A word is wide, and its pairs are dealt over all parts, beyond this share of a part's tokens.
WIDE = 0.05
# Above the name of any word.
NAMES = 1 << 32


def with_ends(values: np.ndarray, starts: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows with `end` put after each, and where they begin."""
    return np.insert(values, starts[1:], end), starts + np.arange(len(starts))


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: mixed sums of what stands for a byte at its place."""
    data, starts = raw(words)
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(starts[:-1], np.diff(starts)).astype(np.uint64)
    sums = np.cumsum(mixed(((place << np.uint64(8)) + data + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))
    sums = np.concatenate([np.zeros(1, np.uint64), sums])
    return mixed(sums[starts[1:]] - sums[starts[:-1]])


def distinct_keys(high: np.ndarray, low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of numbers, `low` below `size`, in their order, and each row's place among them."""
    keys, places = np.unique(high.astype(np.int64) * size + low, return_inverse=True)
    return keys // size, keys % size, places


def parts_of(one: np.ndarray, two: np.ndarray, parts: int) -> np.ndarray:
    """The part in which a pair, and all triples that go on from it, are summed, by two numbers."""
    return (mixed(mixed(one) + two.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def read_words(documents: Iterator[pa.RecordBatch]) -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents' ids, which are held out, how many tokens each has, ends included, the hashes
    of their words in order, and each token's place among these."""
    end = hashes(pa.array([END], pa.large_string()))
    ids, held, found, tokens, lengths, seen = [], [], [], [], [], 0
    for batch in documents:
        words, starts = split_words(batch.column("text"))
        places, distinct = coded(words)
        own, begins = with_ends(places + seen, starts, seen + len(distinct))
        found.append(np.concatenate([hashes(distinct), end]))
        tokens.append(own)
        lengths.append(np.diff(begins))
        seen += len(found[-1])
        ids.append(batch.column("doc_id"))
        held.append(batch.column("held_out").to_numpy(zero_copy_only=False))
    distinct, places = np.unique(np.concatenate(found), return_inverse=True)
    return ids, np.concatenate(held), np.concatenate(lengths), distinct, places.astype(np.int32)[np.concatenate(tokens)]


def range_cuts(hashed: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the even ranges of hashes begins among sorted ones, and the last one ends."""
    number = (hashed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    return np.searchsorted(number, np.arange(ranges + 1, dtype=np.uint64))


class Block:
    """The tokens of a block's documents, ends included, and their distinct pairs and triples.

    A word is its place in `vocabulary`, the names of the block's words in order. A history begins
    with the end of the text before. Pairs stand in the order of part, first and second word,
    triples in that of their pair and third word, so that whoever reads the same documents again
    knows which answer is whose. All pairs that begin with one word are in one part, unless the word
    is a wide one.
    """

    def __init__(self, documents: Iterator[pa.RecordBatch], named: pa.Table, parts: int, ranges: int):
        self.ids, self.held, self.lengths, hashed, tokens = read_words(documents)
        cuts = range_cuts(hashed, ranges)
        names, known, wide = (np.zeros(len(hashed), np.int64) for _ in range(3))
        for number, answer in zip(named["range"].to_pylist(), named["answer"]):
            own = slice(cuts[number], cuts[number + 1])
            rank, known[own], wide[own] = _unpack(answer.as_py(), NAMED)
            names[own] = rank * ranges + number
        order = np.argsort(names)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.vocabulary, self.known, self.wide = names[order], known[order], wide[order].astype(bool)
        self.tokens, size = rank[tokens], len(names)

        begins = np.cumsum(self.lengths) - self.lengths
        self.row = np.repeat(np.arange(len(begins), dtype=np.int32), self.lengths)
        self.one = np.concatenate([self.tokens[:1], self.tokens[:-1]])
        self.one[begins] = rank[np.searchsorted(hashed, hashes(pa.array([END], pa.large_string()))[0])]
        self.second = np.ones(len(self.tokens), bool)
        self.second[begins] = False

        training = ~self.held[self.row]
        a, b, places = distinct_keys(self.one, self.tokens, size)
        part = parts_of(self.vocabulary[a], np.where(self.wide[a], self.vocabulary[b] + 1, 0), parts)
        order = np.argsort(part, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.part, self.a, self.b, self.pair = part[order], a[order], b[order], rank[places]
        self.pair_counts = np.bincount(self.pair[training], minlength=len(a))
        at = np.flatnonzero(self.second)
        self.owner, self.third, places = distinct_keys(self.pair[at - 1], self.tokens[at], size)
        self.triple = np.full(len(self.tokens), -1, np.int32)
        self.triple[at] = places
        self.triple_counts = np.bincount(places[training[at]], minlength=len(self.owner))

    def ranges(self) -> Iterator[tuple[int, slice, slice]]:
        """Each part with its range of pairs and of triples."""
        cuts = np.append(np.flatnonzero(np.diff(self.part, prepend=-1)), len(self.part))
        borders = np.searchsorted(self.owner, cuts)
        for i, begin in enumerate(cuts[:-1]):
            yield int(self.part[begin]), slice(begin, cuts[i + 1]), slice(borders[i], borders[i + 1])

    def firsts(self, own: slice) -> tuple[np.ndarray, np.ndarray]:
        """The distinct first words of a part's pairs, and how many pairs each has."""
        begins = np.flatnonzero(np.diff(self.a[own], prepend=-1))
        return self.a[own][begins], np.diff(begins, append=own.stop - own.start)

    def parcels(self) -> Iterator[tuple[int, bytes]]:
        """Per part the pairs and triples, with their counts in the training documents of the block."""
        name = self.vocabulary
        for part, own, thirds in self.ranges():
            first, width = self.firsts(own)
            follow = np.bincount(self.owner[thirds] - own.start, minlength=own.stop - own.start)
            yield part, _packed(
                np.diff(name[first], prepend=0), width, self.wide[first], name[self.b[own]], self.pair_counts[own],
                follow, name[self.third[thirds]], self.triple_counts[thirds],
            )


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, behind each array's size and the bytes that its numbers take.
    First all lowest bytes of an array, then the next ones: high ones are much alike."""
    heads, planes = [], []
    for a in arrays:
        a = np.ascontiguousarray(a, np.int64)
        most, least = (int(a.max()), int(a.min())) if len(a) else (0, 0)
        wide = 8 if least < 0 else (most.bit_length() + 7) // 8
        heads.append(len(a) << 4 | wide)
        planes.append(a.view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes())
    return np.array(heads, np.uint32).tobytes() + pa.compress(b"".join(planes), "zstd", asbytes=True)


def _unpack(parcel: bytes, arrays: int) -> list[np.ndarray]:
    heads = np.frombuffer(parcel[: 4 * arrays], np.uint32).astype(np.int64)
    sizes, wide = heads >> 4, heads & 15
    data = np.frombuffer(pa.decompress(parcel[4 * arrays :], int((sizes * wide).sum()), "zstd", asbytes=True), np.uint8)
    found = []
    for n, w, end in zip(sizes, wide, np.cumsum(sizes * wide)):
        numbers = np.zeros((n, 8), np.uint8)
        numbers[:, :w] = data[end - n * w : end].reshape(w, n).T
        found.append(numbers.view(np.int64).reshape(n))
    return found


# The arrays in a parcel and in an answer, of words and of pairs and triples.
WORDS, NAMED, PARCEL, ANSWER = 3, 3, 8, 4


def _training(id_col: str, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == held, F.lit(False))


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows whose crc32(id) mod `folds` is not `held`; a null id is a training
    row. P(w) is the base's add-a-half estimate. A word, and each pair of them, is a state; the arc
    of w from state h has the discounted share of w after h, plus, along h's failure arc, the weight
    left over times the probability that the shorter history gives w. Probabilities of each state
    add up to one over all words and one unseen word. All pairs and triples of the training texts
    count, however rare.

    The documents are dealt into blocks, which are read three times. First each block sends its
    distinct words with their counts to ranges of hashes, where the words of all blocks are counted
    and named by small numbers, common words by the smallest. Then it sends its distinct pairs and
    triples with their counts, once, compressed and by those names, to the parts in which they are
    summed over all blocks, and has the sums sent back in the order it asked for them. Then the
    answers make the part of the automaton that the block's texts can reach. A part holds about as
    many n-grams as a block does, whatever the corpus. All pairs that begin with one word are summed
    in one part, which also counts them; those of a wide word are dealt over all parts and their
    numbers joined. Words are told apart by 64-bit hashes. A null text is empty: just an end. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", _training("doc_id", folds, held))

    seen = int(rows.select("text").mapInArrow(_tokens, "seen long").agg(F.sum("seen")).first()[0] or 0)
    blocks, parts = (max(1, -(-seen // most)) for most in (BLOCK_TOKENS, PART_TOKENS))
    ranges = -(-blocks // NAMED_BLOCKS)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    dealt = dealt.mapInArrow(_parcel, "block int, parcel binary").repartition(blocks, "block").sortWithinPartitions("block")

    named = durable(
        dealt.mapInArrow(_ask_words(ranges), "range int, block int, parcel binary")
        .repartition(ranges, "range")
        .groupBy("range")
        .applyInArrow(_name(ranges), "range int, block int, answer binary, word long, total long, words long"),
        "lm-words",
        tidy=True,
    )
    total, distinct = (int(x or 0) for x in named.agg(F.sum("total"), F.sum("words")).first())
    names = named.filter("answer is not null").select("block", "range", "answer")
    sums = durable(
        dealt.groupBy("block")
        .cogroup(names.groupBy("block"))
        .applyInArrow(_ask(parts, ranges), "part int, block int, parcel binary")
        .repartition(parts, "part")
        .groupBy("part")
        .applyInArrow(_sum, "part int, block int, answer binary, word long, k long"),
        "lm-sums",
        tidy=True,
    )
    wide = sums.filter("word is not null").groupBy("word").agg(F.sum("k").alias("k"))
    wide = named.filter("word is not null").select("block", "word").join(wide, "word")
    answers = names.unionByName(sums.filter("answer is not null").select("block", "part", "answer"), True)
    answers = answers.unionByName(wide, True)
    kind = dict(rows.dtypes)["doc_id"]
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _traverse(parts, ranges, total, distinct, rows.schema["doc_id"].dataType),
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", COUNTED_BYTES):
        words, _ = split_words(batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array([len(words) + len(batch)])], ["seen"])


def _parcel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each slice and block as one compressed parcel, for the way through the shuffle."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in slices(batches, "text", COUNTED_BYTES):
        column = batch.column("block").to_numpy()
        blocks, parcels = np.unique(column), []
        for block in blocks:
            own = batch.filter(pa.array(column == block)).select(["doc_id", "held_out", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=options) as writer:
                writer.write_batch(own)
            parcels.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(parcels, pa.binary())], ["block", "parcel"])


def _unpacked(parcels: Iterator[pa.Scalar], limit: int) -> Iterator[pa.RecordBatch]:
    """The documents of parcels, in slices of about `limit` bytes however small the parcels are."""
    held, size = [], 0

    def joined() -> Iterator[pa.RecordBatch]:
        return slices(iter(pa.Table.from_batches(held).combine_chunks().to_batches()), "text", limit)

    for parcel in parcels:
        for batch in pa.ipc.open_stream(parcel.as_buffer()):
            held.append(batch)
            size += batch.nbytes
        if size > limit:
            yield from joined()
            held, size = [], 0
    if held:
        yield from joined()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Each block and its documents in slices, from parcels in the order of blocks."""
    rows = (row for b in batches for row in zip(b.column("block").to_pylist(), b.column("parcel")))
    for block, own in groupby(rows, key=lambda row: row[0]):
        yield block, _unpacked((parcel for _, parcel in own), COUNTED_BYTES)


def _ask_words(ranges: int):
    """The distinct words of each block with their counts in training documents and in all, as a parcel for each range."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, documents in _blocks(batches):
            _, held, lengths, hashed, tokens = read_words(documents)
            known = np.bincount(tokens[~np.repeat(held, lengths)], minlength=len(hashed))
            seen = np.bincount(tokens, minlength=len(hashed))
            cuts = range_cuts(hashed, ranges)
            asked = np.flatnonzero(np.diff(cuts))
            parcels = [
                _packed(np.diff(hashed[own].view(np.int64), prepend=0), known[own], seen[own])
                for own in (slice(cuts[r], cuts[r + 1]) for r in asked)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(asked.astype(np.int32)),
                    pa.array(np.full(len(asked), block, np.int32)),
                    pa.array(parcels, pa.binary()),
                ],
                ["range", "block", "parcel"],
            )

    return ask


def _name(ranges: int):
    """The words of a range named, for each block in the order it asked, with their counts in all training documents.

    Wide words are also handed out as rows, one for each block that has them.
    """
    wide_from = WIDE * PART_TOKENS

    def name(table: pa.Table) -> pa.Table:
        parcels = [_unpack(p.as_py(), WORDS) for p in table["parcel"]]
        ends = np.cumsum([len(p[0]) for p in parcels])[:-1]
        distinct, places = np.unique(np.concatenate([np.cumsum(p[0]) for p in parcels]), return_inverse=True)
        known, seen = (
            np.bincount(places, np.concatenate([p[i] for p in parcels]), len(distinct)).astype(np.int64) for i in (1, 2)
        )
        order = np.argsort(-seen, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        wide = seen > wide_from
        lists = np.split(places, ends)
        number, block = table["range"][0].as_py(), table["block"].to_numpy()
        asked = [own[wide[own]] for own in lists]
        named = {
            "range": pa.array(np.full(len(table), number, np.int32)), "block": pa.array(block, pa.int32()),
            "answer": pa.array([_packed(rank[own], known[own], wide[own]) for own in lists], pa.binary()),
        }
        handed = {
            "block": pa.array(np.repeat(block, [len(own) for own in asked]), pa.int32()),
            "word": pa.array(rank[np.concatenate(asked)] * ranges + number),
        }
        totals = {"total": pa.array([known.sum()]), "words": pa.array([np.count_nonzero(known)])}
        return _filled(
            [named, handed, totals],
            {
                "range": pa.int32(), "block": pa.int32(), "answer": pa.binary(), "word": pa.int64(),
                "total": pa.int64(), "words": pa.int64(),
            },
        )

    return name


def _filled(pieces: list[dict[str, pa.Array]], kinds: dict[str, pa.DataType]) -> pa.Table:
    """The pieces below each other; a column that a piece has not is null there."""
    sizes = [len(next(iter(piece.values()))) for piece in pieces]
    return pa.concat_tables([
        pa.table({name: piece.get(name, pa.nulls(size, kind)) for name, kind in kinds.items()})
        for piece, size in zip(pieces, sizes)
    ])


def _ask(parts: int, ranges: int):
    """The distinct pairs and triples of a block, as a parcel for each part."""

    def ask(key, parcels: pa.Table, named: pa.Table) -> pa.Table:
        own = []
        if len(parcels):
            own = list(Block(_unpacked(parcels["parcel"], COUNTED_BYTES), named, parts, ranges).parcels())
            pa.default_memory_pool().release_unused()
        return pa.table(
            {
                "part": pa.array([part for part, _ in own], pa.int32()),
                "block": pa.array(np.full(len(own), key[0].as_py(), np.int32)),
                "parcel": pa.array([parcel for _, parcel in own], pa.binary()),
            }
        )

    return ask


def _sum(table: pa.Table) -> pa.Table:
    """The counts of a part's pairs and triples over all blocks, in the order each block asked for them.

    A pair's answer also has the number of the triples that go on from it, and the answer of a first
    word that of the pairs that go on from it. Of a wide word a part has some of these pairs only:
    their number is handed out as a row of the word.
    """
    parcels = [_unpack(p.as_py(), PARCEL) for p in table["parcel"]]
    ends, ends1, ends3 = (np.cumsum([len(p[i]) for p in parcels])[:-1] for i in (3, 0, 6))
    first = np.concatenate([np.cumsum(p[0]) for p in parcels])
    width, wide, b, counts, follow, third, counts3 = (np.concatenate([p[i] for p in parcels]) for i in range(1, PARCEL))
    del parcels
    a, _, places = distinct_keys(np.repeat(first, width), b, NAMES)
    c = np.bincount(places, counts, len(a)).astype(np.int64)
    owner, _, places3 = distinct_keys(np.repeat(places, follow), third, NAMES)
    c3 = np.bincount(places3, counts3, len(owner)).astype(np.int64)
    k = np.bincount(owner, c3 > 0, len(a)).astype(np.int64)
    word, which = np.unique(a, return_inverse=True)
    of_word = np.bincount(which, c > 0, len(word)).astype(np.int64)
    at = np.searchsorted(word, first)
    answers = [
        _packed(c[own], k[own], of_word[own1], c3[own3])
        for own, own1, own3 in zip(np.split(places, ends), np.split(at, ends1), np.split(places3, ends3))
    ]
    handed = np.unique(at[wide > 0])
    answered = {"part": table["part"].combine_chunks(), "block": table["block"].combine_chunks(), "answer": pa.array(answers, pa.binary())}
    worded = {"word": pa.array(word[handed]), "k": pa.array(of_word[handed])}
    kinds = {"part": pa.int32(), "block": pa.int32(), "answer": pa.binary(), "word": pa.int64(), "k": pa.int64()}
    pa.default_memory_pool().release_unused()
    return _filled([answered, worded], kinds)


class Automaton:
    """States are single words and pairs of them; the root gives every word its base share.

    An arc holds the discounted share of a word after a state; what the arcs leave is the weight of
    the state's failure arc, which leads from a pair to its second word and from a word to the root.
    """

    def __init__(self, block: Block, answers: pa.Table):
        self.block = block
        # Count, and number of the words that go on, of each word and each pair of the block; 0 if
        # unseen. Every occurrence of a history goes on, if only to the end, so the sum of the
        # counts that go on is the count itself.
        self.words = np.stack([block.known, np.zeros(len(block.known), np.int64)])
        self.pairs = np.zeros((2, len(block.a)), np.int64)
        self.triples = np.zeros(len(block.third), np.int64)
        parted = answers.filter(pc.is_valid(answers["part"]))
        of_part = dict(zip(parted["part"].to_pylist(), parted["answer"]))
        for part, own, thirds in block.ranges():
            *self.pairs[:, own], self.words[1, block.firsts(own)[0]], self.triples[thirds] = _unpack(
                of_part[part].as_py(), ANSWER
            )
        worded = answers.filter(pc.is_valid(answers["word"]))
        self.words[1, np.searchsorted(block.vocabulary, worded["word"].to_numpy())] = worded["k"].to_numpy()

    def traverse(self, base: np.ndarray) -> np.ndarray:
        """The probability of each token on the way from left to right.

        After each token the automaton is in the state of the longest history that the token ends,
        which depends on the last two tokens alone; so the way through all texts is taken at once.
        """
        block = self.block
        p = _stepped(base, self.pairs[0][block.pair], self.words[:, block.one], True)
        history = np.append(self.pairs, np.zeros((2, 1), np.int64), axis=1)[:, np.concatenate([[-1], block.pair[:-1]])]
        return _stepped(p, np.append(self.triples, 0)[block.triple], history, block.second)


def _stepped(shorter: np.ndarray, counts: np.ndarray, state: np.ndarray, inside: np.ndarray | bool) -> np.ndarray:
    """The probability after a state, from its arc's count and the probability by the shorter history."""
    c, k = state
    there = inside & (c > 0)
    c = np.maximum(c, 1)
    return np.where(there, np.maximum(counts - DISCOUNT, 0) / c + (1 - (c - DISCOUNT * k) / c) * shorter, shorter)


def _traverse(parts: int, ranges: int, total: int, distinct_words: int, id_kind):
    def traverse(key, parcels: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(parcels):
            return pa.table({n: pa.array([], t) for n, t in _columns(to_arrow_type(id_kind))})
        named = answers.filter(pc.is_valid(answers["range"]))
        block = Block(_unpacked(parcels["parcel"], SLICE_BYTES), named, parts, ranges)
        automaton = Automaton(block, answers)
        c = block.known[block.tokens]
        base = (c + 0.5) / (total + 0.5 * (distinct_words + 1))
        p = automaton.traverse(base)
        size = len(block.held)
        scored = pa.table(
            {
                "doc_id": pa.chunked_array(block.ids),
                "held_out": pa.array(block.held),
                "n_tokens": pa.array(block.lengths),
                "n_known": pa.array(np.bincount(block.row[c > 0], minlength=size)),
                "train_tokens": pa.array(np.full(size, total)),
                "base_score": pa.array(np.bincount(block.row, np.log10(base), size)),
                "score": pa.array(np.bincount(block.row, np.log10(p), size)),
            }
        )
        # The next block may run in the same process.
        pa.default_memory_pool().release_unused()
        return scored

    return traverse


def _columns(kind: pa.DataType):
    yield "doc_id", kind
    yield "held_out", pa.bool_()
    for name in ("n_tokens", "n_known", "train_tokens"):
        yield name, pa.int64()
    for name in ("base_score", "score"):
        yield name, pa.float64()
