"""Repeated passages: difference-cover anchors find texts that share one, whole windows confirm it.

A text hashes short windows only where its word number, modulo a period, lies in a difference cover.
Two places of two texts that agree over a whole window hold, wherever the texts' numbering puts them, one anchor at the
same distance, since the cover has two members at every distance. So windows around anchors of one
text alone need no look; all others are hashed in full and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.functions.durable import durable
from plugtide.functions.lookups import attach
from plugtide.llm.words import coded, mixed, slices, split_words

# For a period, numbers whose differences give every residue of it.
COVERS = {
    1: [0],
    3: [0, 1],
    7: [0, 1, 3],
    13: [0, 1, 3, 9],
    21: [0, 1, 4, 14, 16],
    31: [0, 1, 3, 8, 12, 18],
    57: [0, 1, 3, 13, 32, 36, 43, 52],
}
# Two odd multipliers, one for each half of a window's hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
EMPTY = hashlib.sha256(b"").hexdigest()
LAST = (1 << 63) - 1


def period_of(window: int) -> int:
    """The largest period that leaves anchors of at least a third of a window."""
    return max(p for p in COVERS if 3 * (window + 1 - p) >= window)


def word_hashes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, the 64-bit hash of each, and where each text's words begin and the last end."""
    words, starts = split_words(texts, lower=False)
    if not len(words):
        return words, np.zeros(0, np.uint64), starts
    places, distinct = coded(words)
    plain = distinct.cast(pa.large_binary()).to_pylist()
    return words, np.fromiter(map(xxhash.xxh3_64_intdigest, plain), np.uint64, len(plain))[places], starts


def window_hashes(own: np.ndarray, at: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of the `size` words from each place in `at` on, from running sums modulo 2^64."""
    powers = _powers(base, len(own))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(own * powers)])
    back = _powers(pow(base, -1, 1 << 64), len(own))
    return mixed((sums[at + size] - sums[at]) * back[at])


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(max(count, 1), base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)[:count]


def joined_digest(words: pa.Array) -> bytes:
    """SHA-256 of the words with one space between two."""
    return hashlib.sha256(b" ".join(words.cast(pa.large_binary()).to_pylist())).digest()


def _places(lengths: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors' places in the words of all texts, and where each text's begin and the last end."""
    period = period_of(window)
    cover, size = COVERS[period], window + 1 - period
    found = []
    for start, length in zip(starts[:-1], lengths):
        turns = np.arange(0, max(int(length) - size + 1, 0) if length >= window else 0, period)
        own = (turns[:, None] + np.array(cover)).ravel()
        found.append(start + own[own + size <= length])
    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64), ends


def _read(window: int):
    size = window + 1 - period_of(window)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, own, starts = word_hashes(batch.column("text"))
            lengths = np.diff(starts)
            at, ends = _places(lengths, starts, window)
            anchors = window_hashes(own, at, size, BASES[0]).view(np.int64)
            digests = [joined_digest(words[s:e]) for s, e in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("place"),
                    batch.column("mark"),
                    pa.array(lengths, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(anchors)),
                ],
                ["doc_id", "place", "mark", "n_words", "digest", "tag", "anchors"],
            )

    return read


def _candidates(window: int):
    """Texts with their windows around shared anchors: twice a window's first word, and 1 more if one of
    its anchors also stands in a smaller document."""
    period = period_of(window)
    cover = np.array(COVERS[period])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, starts = split_words(batch.column("text"), lower=False)
            found, asked = [], []
            for n, spots in zip(np.diff(starts), batch.column("spots")):
                k = spots.values.to_numpy()
                near = [_near(k // 2, n), _near(k[k % 2 == 1] // 2, n)]
                found.append(np.flatnonzero(near[0]))
                asked.append(near[1][found[-1]])
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            firsts = np.concatenate(found) if found else np.zeros(0, np.int64)
            asks = np.concatenate(asked) if asked else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("row", "place", "digest", "text")],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(2 * firsts + asks, pa.int32())),
                ],
                ["row", "place", "digest", "text", "firsts"],
            )

    def _near(k: np.ndarray, n: int) -> np.ndarray:
        """Whether the window from each word on holds one of these anchors."""
        anchors = k // len(cover) * period + cover[k % len(cover)]
        steps = np.zeros(n + 2, np.int64)
        np.add.at(steps, np.maximum(anchors - period + 1, 0), 1)
        np.add.at(steps, anchors + 1, -1)
        return np.cumsum(steps)[: n - window + 1] > 0

    return candidates


def _windows(window: int, asking: bool):
    """One row per candidate window: its 128-bit hash, the text's row and place, its first word.

    With `asking` only windows that a smaller document may hold.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, own, starts = word_hashes(batch.column("text"))
            firsts = batch.column("firsts")
            rows = np.repeat(np.arange(len(batch)), pc.list_value_length(firsts).to_numpy(zero_copy_only=False))
            first = firsts.flatten().to_numpy()
            if asking:
                rows, first = rows[first % 2 == 1], first[first % 2 == 1]
            first = first // 2
            halves = [pa.array(window_hashes(own, first + starts[rows], window, base).view(np.int64)) for base in BASES]
            yield pa.RecordBatch.from_arrays(
                [*halves, *[pa.array(batch.column(c).to_numpy()[rows]) for c in ("row", "place")], pa.array(first, pa.int32())],
                ["h1", "h2", "row", "place", "first"],
            )

    return windows


def _cut(window: int):
    """What is left of a text after the words of its repeated windows are gone."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, starts = split_words(batch.column("text"), lower=False)
            removed, digests, spans = [], [], []
            for s, e, repeated in zip(starts[:-1], starts[1:], batch.column("repeated")):
                steps = np.zeros(int(e - s) + 1, np.int64)
                first = repeated.values.to_numpy()
                np.add.at(steps, first, 1)
                np.add.at(steps, first + window, -1)
                gone = np.cumsum(steps)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                left = words[s:e].filter(pa.array(~gone))
                removed.append(int(gone.sum()))
                digests.append(joined_digest(left).hex())
                spans.append(edges.astype(np.int32))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.array(np.concatenate(spans) if spans else np.zeros(0, np.int32), pa.int32()),
                    ),
                ],
                ["digest", "_removed", "_kept", "_spans"],
            )

    return cut


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, removed_spans.

    A word is removed when it lies in a run of `window` words that also starts in a document with a
    smaller id. `removed_spans` lists the first word and the one after the last of each stretch that
    goes; `kept_sha256` is of the words left, with one space between two.

    Texts with the same words are one text under their smallest id; its other rows lose all their
    words if they fill a window. Between different texts, only windows around anchors that at
    least two texts have are hashed (128 bits) and grouped, and only those with an anchor of a smaller
    document ask for their first place. All sums are made before the shuffle, and hashes that many
    texts have go back to them by a lookup that keeps hot keys spread, so no task sees all places
    of a passage and no pairs of places are made.

    A null text has no words; it and texts shorter than a window lose nothing. A null id counts as
    larger than every other. Rows of equal id never remove anything from each other. An empty table
    gives an empty one; other columns are not looked at.
    """
    text = F.col(text_col)
    given = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col), F.lit(LAST)).cast("long").alias("place"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
    )
    kind = given.schema["doc_id"].dataType.simpleString()
    read = given.mapInArrow(
        _read(window),
        f"doc_id {kind}, place long, mark long, n_words long, digest binary, tag long, anchors array<long>",
    )
    rows = durable(read.withColumn("row", F.monotonically_increasing_id()), "passages")

    least = F.min_by(F.struct("row", "mark"), "place")
    texts = rows.groupBy("digest").agg(F.min("place").alias("least"), least.alias("_it"), F.count(F.lit(1)).alias("_rows"))
    texts = durable(texts.select("digest", "least", "_it.row", "_it.mark", "_rows"), "texts")

    shared = (
        rows.select("tag", "place", F.explode("anchors").alias("hash"))
        .groupBy("hash")
        .agg(
            F.min("tag").alias("low"), F.max("tag").alias("high"),
            F.min("place").alias("_first_place"), F.count(F.lit(1)).alias("_rows"),
        )
        .filter("low <> high")
        .select("hash", "_first_place", "_rows")
    )
    anchors = rows.select("row", "place", F.posexplode("anchors").alias("spot", "hash"))
    hits = attach(anchors, shared, ["hash"], rows_per_key="_rows", broadcast_bytes=0).filter("_first_place IS NOT NULL")
    later = (F.col("_first_place") < F.col("place")).cast("int")
    spots = hits.groupBy("row").agg(F.collect_list(F.col("spot") * 2 + later).alias("spots"))
    # Of equal texts only the one with the smallest id is looked into.
    spots = spots.join(texts.select("row", "digest", F.col("least").alias("place"), "mark"), "row")
    looked = given.select("place", "mark", "text").join(spots, ["place", "mark"]).dropDuplicates(["place", "mark"])
    found = durable(
        looked.select("row", "place", "digest", "text", "spots").mapInArrow(
            _candidates(window), "row long, place long, digest binary, text string, firsts array<int>"
        ),
        "candidates",
    )
    def windows(asking: bool) -> DataFrame:
        of_text = found.select("row", "place", "text", "firsts")
        return of_text.mapInArrow(_windows(window, asking), "h1 long, h2 long, row long, place long, first int")

    earliest = (
        windows(False)
        .groupBy("h1", "h2")
        .agg(F.min("place").alias("_first_place"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
    )
    repeated = (
        attach(windows(True), earliest, ["h1", "h2"], rows_per_key="_rows", broadcast_bytes=0)
        .filter("_first_place < place")
        .groupBy("row")
        .agg(F.collect_list("first").alias("repeated"))
    )
    cut = (
        found.select("row", "digest", "text")
        .join(repeated, "row")
        .select("digest", "text", "repeated")
        .mapInArrow(_cut(window), "digest binary, _removed long, _kept string, _spans array<int>")
    )
    results = texts.join(cut, "digest", "left")
    answered = attach(rows.select("doc_id", "place", "n_words", "digest"), results.drop("row", "mark"), ["digest"], "_rows", 0)
    copy = (F.col("place") > F.col("least")) & (F.col("n_words") >= window)
    first = (F.col("place") == F.col("least")) & F.col("_removed").isNotNull()
    whole = F.array(F.lit(0), F.col("n_words").cast("int"))
    return answered.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(first, F.col("_removed")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).when(first, F.col("_kept")).otherwise(F.lower(F.hex("digest"))).alias("kept_sha256"),
        F.when(copy, whole).when(first, F.col("_spans")).otherwise(F.array().cast("array<int>")).alias("removed_spans"),
    )


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """`docs` with repeated passages cut out of their texts, as words with one space between two.

    Texts that lose nothing stay as they are. Rows, and all other columns, stay; ids must be unique.
    """
    spans = repeated_passages(docs, id_col, text_col, window).filter("n_removed > 0")
    gone = spans.select(F.col("doc_id").alias("_of"), F.col("removed_spans").alias("_gone"))
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            words, starts = split_words(batch.column(text_col), lower=False)
            out = batch.column(text_col).to_pylist()
            for row, edges in enumerate(batch.column("_gone").to_pylist()):
                if edges:
                    own = words[starts[row] : starts[row + 1]].to_pylist()
                    bounds = [0, *edges, len(own)]
                    out[row] = " ".join(w for a, b in zip(bounds[::2], bounds[1::2]) for w in own[a:b])
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type)).select(columns)

    return docs.join(gone, docs[id_col].eqNullSafe(gone["_of"]), "left").drop("_of").mapInArrow(cut, docs.schema)
