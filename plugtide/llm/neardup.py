"""Near duplicates: a multi-index Hamming join of minhash signatures, confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.functions.durable import durable
from plugtide.llm.components import components
from plugtide.llm.words import coded, mixed, slices, split_words

# A signature has CHUNKS x CHUNK minhash values of BITS bits; its distance to another is the number
# of values that differ.
CHUNKS, CHUNK, BITS = 12, 5, 16
VALUES = CHUNKS * CHUNK
# One error is enumerated in each chunk, so every pair of signatures within this distance is found:
# with more than one error in all chunks the distance would be at least 2 * CHUNKS.
DISTANCE = 2 * CHUNKS - 1
# A finer sketch, of many more minhash values with few bits, judges candidates before their sets do: it
# takes 512 bytes, whatever the set, and its spread is that of some 1,500 whole values.
SKETCH, SKETCH_BITS = 2048, 2
# Members of a bucket that are compared in one task at once.
TILE = 1024

# One odd multiplier per minhash value.
_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, VALUES + SKETCH, dtype=np.uint64) | np.uint64(1)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of each text's shingles as sorted 64-bit hashes, and where each text's begin.

    A text of fewer words than a shingle is one shingle as a whole; one without words has none.
    """
    words, starts = split_words(texts)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    places, distinct = coded(words)
    plain = distinct.cast(pa.large_binary()).to_pylist()
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, plain), np.uint64, len(plain))[places]
    lengths = np.diff(starts)
    sets = []
    joined = own.copy()
    for k in range(1, size):
        joined[: len(joined) - k] = mixed(joined[: len(joined) - k]) + own[k:]
    joined = mixed(joined)
    for start, length in zip(starts[:-1], lengths):
        if length >= size:
            sets.append(np.unique(joined[start : start + length - size + 1]))
        elif length:
            whole = own[start : start + length].tobytes()
            sets.append(np.array([xxhash.xxh3_64_intdigest(whole, seed=1)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minhash signature of each non-empty set, as rows of 16-bit values."""
    out = np.empty((len(starts) - 1, VALUES), np.uint16)
    for k in range(VALUES):
        out[:, k] = _minhash(values, starts, k, BITS)
    return out


def sketches(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The finer sketch of each non-empty set, as rows of bytes with four values each."""
    out = np.zeros((len(starts) - 1, SKETCH // 4), np.uint8)
    for k in range(SKETCH):
        out[:, k // 4] |= _minhash(values, starts, VALUES + k, SKETCH_BITS).astype(np.uint8) << np.uint8(2 * (k % 4))
    return out


def sketch_distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The number of values in which the sketches of two lists differ, row by row."""
    differ = np.ascontiguousarray(one).view(np.uint64) ^ np.ascontiguousarray(two).view(np.uint64)
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def _minhash(values: np.ndarray, starts: np.ndarray, k: int, bits: int) -> np.ndarray:
    return mixed(np.minimum.reduceat(values * _MULTIPLIERS[k], starts[:-1])) >> np.uint64(64 - bits)


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """Per signature its CHUNKS x CHUNK keys: each chunk with each of its values left out in turn.

    Chunks with at most one differing value share the key that leaves it out.
    """
    keys = np.empty((len(signature), VALUES), np.uint64)
    for chunk in range(CHUNKS):
        part = signature[:, chunk * CHUNK : (chunk + 1) * CHUNK].astype(np.uint64)
        for out in range(CHUNK):
            key = np.full(len(part), chunk * CHUNK + out + 1, np.uint64)
            for place in range(CHUNK):
                if place != out:
                    key = mixed(key) + part[:, place]
            keys[:, chunk * CHUNK + out] = mixed(key)
    return keys.view(np.int64)


def _sign(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, starts = shingles(batch.column("text"), size)
            counts = np.diff(starts)
            full = np.flatnonzero(counts)
            begins = np.concatenate([starts[:-1][full], starts[-1:]])
            signed: list[bytes | None] = [None] * len(counts)
            sums = np.zeros((2, len(counts)), np.uint64)
            if len(full):
                for row, signature in zip(full, signatures(values, begins)):
                    signed[row] = signature.tobytes()
                for i, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                    sums[i][full] = np.add.reduceat(mixed(values ^ np.uint64(salt)), begins[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array(signed, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set1", "set2", "signature"],
            )

    return sign


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, VALUES)
        keys = chunk_keys(signature).ravel()
        nodes = np.repeat(batch.column("node").to_numpy(), VALUES)
        slots = np.tile(np.arange(VALUES, dtype=np.int32), len(signature))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes), pa.array(slots)], ["key", "node", "slot"])


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, starts = shingles(batch.column("text"), size)
            own = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))
            # Every text here has shingles: it shares a key with another.
            fine = [s.tobytes() for s in sketches(values, starts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), own, pa.array(fine, pa.binary())], ["node", "set", "sketch"]
            )

    return sets


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; one pair at a time is in memory."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    joined = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    either = F.size("set_a") + F.size("set_b") - F.col("common")
    return durable(joined.filter(100 * F.col("common") >= percent * either).select("a", "b"), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 x common >= `percent` x all of their distinct shingles of
    `shingle` words; a component is named by its smallest id, and that document is kept.

    * Documents with equal sets are one node from the start, named by the smallest id, whatever
      their number; equality is that of 128 bits summed over the set.
    * Each node's signature gives one key per chunk and allowed error. Nodes that share a key meet
      in its bucket, so every pair within `DISTANCE` is a candidate; of pairs at 85 % (80 %) about
      one in 10^9 (10^7) shares no key.
    * Each node is first held against one hub, the smallest node of all its buckets; the links found
      are joined to components. In buckets that still hold several, the smallest node of the
      largest component is held against the smallest of every other.
    * What is then left are buckets with several components. There only nodes outside a bucket's
      largest component are compared with the rest, in tiles of bounded size, on signatures and
      then on finer sketches inside the task: first for the nearest node of another component in
      each tile, and once those links are joined for all. A pair leaves the task once, in the
      first key it shares, and only if both distances allow the similarity, but for some one in
      10^6 of pairs just at it. No pair inside a component and none of a far-off distance is
      ever written out.
    * Links are confirmed on the whole sets, as 64-bit hashes of shingles.

    Ids are whole numbers. Texts without words are linked with nothing. Rows without an id are linked with nothing and
    kept; rows with the same id count as one document. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = durable(
        rows.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, set1 long, set2 long, signature binary"), "signatures"
    )
    of_set = ["n_shingles", "set1", "set2"]
    nodes = (
        signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        .groupBy(*of_set)
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    )
    nodes = durable(nodes, "nodes")

    keyed = nodes.select("node", "signature").mapInArrow(_key_rows, "key long, node long, slot int")
    buckets = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    members = durable(keyed.join(buckets.select("key", "least"), "key"), "members")
    found = members.select(F.col("node").alias("id")).distinct()
    sets = durable(
        rows.join(found, F.col("doc_id") == F.col("id"), "left_semi")
        .select(F.col("doc_id").alias("node"), "text")
        .mapInArrow(_sets(shingle), "node long, set array<long>, sketch binary"),
        "sets",
    )

    hub = F.min("least").alias("a")
    first = members.filter("node <> least").groupBy("node").agg(hub).select("a", F.col("node").alias("b"))
    links = _linked(first, sets, percent)
    links = links.unionByName(_linked(_hub_pairs(members, components(links)), sets, percent))
    for nearest in (True, False):
        rest = _rest_of_pairs(members, nodes, sets, components(links), percent, nearest)
        links = links.unionByName(_linked(rest, sets, percent))
    label = components(links)

    named = nodes.select(*of_set, "node").join(label, "node", "left")
    named = named.select(*of_set, F.coalesce("component", "node").alias("component"))
    result = signed.select("doc_id", *of_set).join(named, of_set, "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    own = members.select("key", "slot", "node").join(label.withColumnRenamed("component", "label"), "node", "left")
    return durable(own.select("key", "slot", "node", F.coalesce("label", "node").alias("label")), "labelled")


def _hub_pairs(members: DataFrame, label: DataFrame) -> DataFrame:
    """Per bucket the smallest node of its largest component against that of each other component."""
    parts = _labelled(members, label).groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    parts = durable(parts, "bucket-parts")
    main = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "label", "node")).alias("main"))
    others = parts.join(main.filter("parts > 1").select("key", "main"), "key").filter(F.col("label") != F.col("main.label"))
    return others.select(F.least("node", "main.node").alias("a"), F.greatest("node", "main.node").alias("b")).distinct()


def _rest_of_pairs(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, label: DataFrame, percent: int, nearest: bool
) -> DataFrame:
    """Candidate pairs (a, b) of different components, each once; with `nearest` one for a node and tile."""
    own = _labelled(members, label)
    sizes = own.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        sizes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("largest"))
        .filter("labels > 1")
        .select(
            "key",
            F.col("largest.label").alias("main"),
            F.ceil(F.col("all") / TILE).cast("int").alias("across"),
            F.ceil((F.col("all") - F.col("largest.n")) / TILE).cast("int").alias("down"),
            F.col("all"),
            (F.col("all") - F.col("largest.n")).alias("outside"),
        )
    )
    mixed = durable(mixed, "mixed-buckets")
    marks = nodes.select("node", "signature").join(sets.select("node", "sketch").dropDuplicates(["node"]), "node")
    open_rows = durable(own.join(mixed.drop("all", "outside"), "key").join(marks, "node"), "open-buckets")
    tile = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    all_tiles = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["key", "slot", "node", "label", "signature", "sketch"]
    right = open_rows.select(*columns, F.lit(False).alias("asks"), tile("across").alias("i"), all_tiles("down").alias("j"))
    left = open_rows.filter("label <> main").select(
        *columns, F.lit(True).alias("asks"), tile("down").alias("j"), all_tiles("across").alias("i")
    )
    cells = left.unionByName(right)
    # Cells have at most some 2 x TILE rows; several small ones share a group.
    groups = _groups(mixed)
    cells = cells.withColumn("group", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)))
    compared = _compared(max(_reach(VALUES, BITS, percent, 6), DISTANCE), _reach(SKETCH, SKETCH_BITS, percent, 5), nearest)
    return cells.groupBy("group").applyInArrow(compared, "a long, b long").distinct()


def _groups(mixed: DataFrame) -> int:
    """Groups of some 4 x TILE rows of cells; a row stands in a cell for each tile of the other side."""
    rows = mixed.agg(F.sum(F.col("all") * F.col("down") + F.col("outside") * F.col("across"))).first()[0]
    return max(1, -(-int(rows or 0) // (4 * TILE)))


def _reach(values: int, bits: int, percent: int, spreads: float) -> int:
    """The distance that two sets just similar enough keep to, but for so many standard deviations."""
    p = (1 - percent / 100) * (1 - 0.5**bits)
    return int(values * p + spreads * math.sqrt(values * p * (1 - p)))


def _compared(reach: int, fine_reach: int, nearest: bool):
    def compare(table: pa.Table) -> pa.Table:
        key, i, j, node, label = (table[c].to_numpy() for c in ("key", "i", "j", "node", "label"))
        asks, slot = table["asks"].to_numpy(), table["slot"].to_numpy()
        signature, sketch = (
            np.frombuffer(b"".join(table[c].to_pylist()), kind).reshape(len(table), -1)
            for c, kind in (("signature", np.uint16), ("sketch", np.uint8))
        )
        order = np.lexsort((j, i, key))
        cell = np.stack([key[order], i[order], j[order]])
        borders = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
        found = [np.zeros((2, 0), np.int64)]
        for rows in np.split(order, borders):
            left, right = rows[asks[rows]], rows[~asks[rows]]
            for some in np.array_split(left, max(1, -(-len(left) * max(1, len(right)) // 20_000))):
                differ = signature[some][:, None, :] != signature[right][None, :, :]
                x, y = np.nonzero((differ.sum(axis=2) <= reach) & (label[some][:, None] != label[right][None, :]))
                at = _first_shared(differ[x, y].reshape(-1, CHUNKS, CHUNK)) == slot[rows[0]]
                x, y = some[x[at]], right[y[at]]
                apart = sketch_distances(sketch[x], sketch[y])
                at = np.flatnonzero(apart <= fine_reach)
                if nearest:
                    at = at[np.lexsort((node[y[at]], apart[at], x[at]))]
                    at = at[np.unique(x[at], return_index=True)[1]]
                a, b = node[x[at]], node[y[at]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _first_shared(differ: np.ndarray) -> np.ndarray:
    """The first key that each pair shares: in the first chunk with at most one error, the key that
    leaves the error out."""
    chunk = np.argmax(differ.sum(axis=2) <= 1, axis=1)
    return chunk * CHUNK + np.argmax(differ[np.arange(len(differ)), chunk], axis=1)


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """`docs` without the near copies: of each component the document with the smallest id stays.

    All columns stay as they came. Rows without an id stay, and so do null and empty texts, which are linked
    with nothing. Rows that repeat an id are one document and go or stay together. An empty table
    stays empty.
    """
    groups = near_duplicates(docs, id_col, text_col, shingle, percent)
    gone = groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
