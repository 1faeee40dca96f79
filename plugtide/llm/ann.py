"""Nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugtide.functions.durable import durable

# Vectors that the rotations and the radius are learned from, on average over hashes.
SAMPLE = 8_000
SAMPLE_QUERIES = 300
# Rotations, each giving one bit per dimension; bits of a substring; steps of learning.
ROTATIONS = 2
CHUNK = 8
STEPS = 25
# Share of the sample's true neighbours that the radius takes in.
REACH = 0.98
# Rows and queries of a block.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 512
_WEIGHT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Codes:
    """Rotations whose signs are a vector's code, and the Hamming radius to search.

    Each rotation starts from the sample's principal axes turned at random, and is then turned so
    that the vectors lie as near as possible to the corners they are rounded to.
    """

    def __init__(self, sample: np.ndarray, neighbours: int):
        random = np.random.default_rng(11)
        dimension = sample.shape[1]
        axes = np.linalg.eigh(sample.T @ sample)[1].T
        self.rotations = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(random.normal(size=(dimension, dimension)))[0]
            projected = sample @ axes.T
            for _ in range(STEPS if len(sample) else 0):
                corners = np.where(projected @ turn >= 0, 1.0, -1.0)
                u, _, vt = np.linalg.svd(corners.T @ projected)
                turn = (u @ vt).T
            self.rotations.append(axes.T @ turn)
        self.bits = -(-ROTATIONS * dimension // CHUNK) * CHUNK
        self.radius = self._learned_radius(sample, neighbours)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """The codes, as one byte per substring."""
        signs = np.concatenate([vectors @ r >= 0 for r in self.rotations], axis=1)
        return np.packbits(signs, axis=1)

    def _learned_radius(self, sample: np.ndarray, neighbours: int) -> int:
        """The distance within which `REACH` of the sample's nearest neighbours lie.

        The whole table holds neighbours that are nearer than the sample's, so it reaches more of them.
        """
        if len(sample) <= neighbours:
            return self.bits
        codes, n = self.encode(sample), min(len(sample), SAMPLE_QUERIES)
        near = sample[:n] @ sample.T
        near[np.arange(n), np.arange(n)] = -np.inf
        best = np.argpartition(-near, neighbours, axis=1)[:, :neighbours]
        distances = _WEIGHT[codes[:n, None, :] ^ codes[best]].sum(axis=2)
        return int(np.quantile(distances, REACH, method="higher"))

    def allowed(self, radius: int) -> list[int]:
        """Errors to allow in each substring. Of two codes within the radius, at least one substring
        stays within its number: else the sum would be over the radius."""
        parts = self.bits // CHUNK
        most, rest = divmod(radius, parts)
        return [min(CHUNK, most if i <= rest else most - 1) for i in range(parts)]


class Index:
    """One table per substring over a block of codes: its rows ordered by the substring's value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = _words(codes)
        self.order = [np.argsort(codes[:, i], kind="stable") for i in range(codes.shape[1])]
        values = np.arange(257)
        self.starts = [np.searchsorted(codes[o, i], values) for i, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int, probes: list[np.ndarray]) -> np.ndarray:
        """All rows within the radius: every allowed error of every substring is probed, and what
        the probes find is held against the whole code."""
        hit = np.zeros(len(self.codes), bool)
        for i, errors in enumerate(probes):
            values = code[i] ^ errors
            begins, lengths = self.starts[i][values], self.starts[i][values + 1] - self.starts[i][values]
            total = int(lengths.sum())
            if total:
                ends = np.cumsum(lengths)
                hit[self.order[i][np.arange(total) + np.repeat(begins - ends + lengths, lengths)]] = True
        found = np.flatnonzero(hit)
        distance = np.bitwise_count(self.words[found] ^ _words(code[None, :])).sum(axis=1, dtype=np.int64)
        return found[distance <= radius]


def _words(codes: np.ndarray) -> np.ndarray:
    return np.pad(codes, ((0, 0), (0, -codes.shape[1] % 8))).view(np.uint64)


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    neighbours: int = 5,
    radius: int | None = None,
) -> DataFrame:
    """One row per neighbour: query_id, rank, vec_id, score, for each vector whose id is divisible by `every`.

    Score is the cosine in double precision. Codes and radius are learned from a bounded sample; all
    rows are coded and indexed. Rows and queries are dealt into blocks by a hash of their ids, and
    each pair of blocks is searched in one task: an index over the rows' substrings, probes of every
    substring, whole codes held against the radius, original vectors compared. A task hands on no
    more than `neighbours` rows per query, so copies of one vector, however many, stay bounded. A
    query that finds fewer is searched again with the radius of the whole code, which is exact.

    Vectors that are null, empty or zero, that hold null or non-finite components, that have no id,
    or whose length is not the most common one take no part. Rows with a query's own id are not its
    neighbours, a repeated query row is answered once. Ties go to the smaller id.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    lengths = sizes.orderBy(F.desc("rows"), F.desc("length")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], result)
    rows = rows.filter(F.size("vector") == lengths.length)

    share = min(1.0, SAMPLE / lengths.rows)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = [r.vector for r in sample.orderBy("vec_id", "vector").collect()]
    known = np.array(known, np.float64).reshape(-1, lengths.length)
    codes = Codes(known / np.linalg.norm(known, axis=1, keepdims=True), neighbours)

    found = durable(_search(rows, rows, codes, every, neighbours, radius or codes.radius, lengths.rows), "ann-found")
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id").distinct()
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= neighbours)
    short = durable(queries.join(full, queries.vec_id == full.query_id, "left_anti"), "ann-short")
    if not short.isEmpty():
        asked = rows.join(short, "vec_id", "left_semi")
        again = _search(rows, asked, codes, every, neighbours, codes.bits, lengths.rows)
        found = found.join(short.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti").unionByName(again)
    return found


def _search(
    rows: DataFrame, queries: DataFrame, codes: Codes, every: int, neighbours: int, radius: int, size: int
) -> DataFrame:
    row_blocks = max(1, -(-size // BLOCK_ROWS))
    query_blocks = max(1, -(-size // (every * BLOCK_QUERIES)))
    dealt = lambda name, n: F.pmod(F.xxhash64("vec_id", F.lit(name)), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("rows", dealt("rows", row_blocks)).withColumn("queries", all_of(query_blocks))
    right = queries.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    # Columns of their own, since both sides may come from the same rows.
    right = right.select(F.col("vec_id").alias("vec_id"), F.col("vector").alias("vector"))
    right = right.withColumn("queries", dealt("queries", query_blocks)).withColumn("rows", all_of(row_blocks))
    errors = np.arange(256, dtype=np.uint8)
    probes = [errors[_WEIGHT <= most].astype(np.int64) for most in codes.allowed(radius)]

    def search(key, block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if len(block) and len(asked):
            ids, vectors = _arrays(block)
            query_ids, query_vectors = _arrays(asked)
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            query_unit = query_vectors / np.linalg.norm(query_vectors, axis=1, keepdims=True)
            index = Index(codes.encode(unit))
            for query, code, vector in zip(query_ids, codes.encode(query_unit), query_vectors):
                at = index.within(code, radius, probes)
                at = at[ids[at] != query]
                score = _cosine(vectors[at], vector)
                best = np.lexsort((ids[at], -score))[:neighbours]
                out.append((np.full(len(best), query), ids[at][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({name: c.astype(kind) for (name, kind), c in zip(kinds.items(), columns)})

    candidates = (
        left.groupBy("rows", "queries")
        .cogroup(right.groupBy("rows", "queries"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cosine(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    # Row sums, so that equal vectors get equal scores wherever they stand.
    return (vectors * query).sum(axis=1) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block."""
    column = table["vector"].combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
    return table["vec_id"].to_numpy(), values
