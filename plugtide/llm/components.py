"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.functions.durable import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is named by its smallest node.

    Large and small stars in turn, until nothing changes: each node hands its larger neighbours to
    its smallest neighbour, then its smaller ones. Edges never grow in number, and rounds grow with
    the logarithm of the longest path. Every round is written to the shared folder.
    """
    now = durable(_clean(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "edges")
    seen = _print(now)
    while True:
        now = durable(_small_star(_large_star(now)), "edges")
        after = _print(now)
        if after == seen:
            break
        seen = after
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _clean(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _clean(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _clean(moved.unionByName(least.select("a", F.col("m").alias("b"))))
