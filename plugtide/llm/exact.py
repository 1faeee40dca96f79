"""Exact duplicates: 128-bit content hash, bytes compared inside a group, smallest id kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide.functions.durable import durable
from plugtide.functions.lookups import attach


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash=lambda t: F.unhex(F.md5(t))
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by `content_hash` of the normalised text (128 bits by default). The bytes are
    compared by grouping on hash and text together: copies merge inside each task first, so a text
    that a third of the rows share reaches the shuffle once per task, and texts whose hashes
    collide come apart. What follows is one short row per distinct text; it is matched to the
    documents on hash and SHA-256, and a pair of texts that agreed in both would end the job with
    an error, never in a wrong group. In that lookup the groups that hold more than a quarter of an
    even partition, at most four per partition, are broadcast, so that their rows stay spread.

    Null and empty texts are equal. Rows with a null id are members of their group but never its
    smallest id; they are kept only when the group has no other id. Rows that repeat the kept row's
    id are kept as well. An empty table gives an empty one; other columns are not looked at.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    hashed = [content_hash(F.col("_text")).alias("_hash"), F.unhex(F.sha2("_text", 256)).alias("_sha")]

    texts = (
        rows.select("doc_id", "_text", hashed[0])
        .groupBy("_hash", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("_rows"))
    )
    groups = (
        texts.select("_hash", hashed[1], "keep_id", "_rows")
        .groupBy("_hash", "_sha")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("_rows").alias("group_size"),
            F.sum("_rows").alias("_rows"),
            F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("Different texts agree in both hashes")))
            .otherwise(F.lit(True))
            .cast("boolean")
            .alias("_one"),
        )
        .filter("_one")
        .drop("_one")
    )
    found = attach(rows.select("doc_id", *hashed), groups, ["_hash", "_sha"], rows_per_key="_rows")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row per group of equal texts, all columns as they came.

    The row that stays is the one that `exact_groups` keeps, told by id and text together: of rows
    that repeat an id, one with another text is judged in its own group. Where several rows of a
    group carry the id that stays, or none of them has an id, one of them stays. An empty table
    stays empty.
    """
    kept = exact_groups(docs, id_col, text_col).filter("kept")
    kept = kept.groupBy(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    kept = durable(kept, "exact-kept")
    named = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col(id_col).alias("_own"),
        F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("_sha"),
    )

    def rows_of(some: DataFrame) -> DataFrame:
        return named.join(some, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_of")), "left_semi")

    left = rows_of(kept.filter("_rows = 1"))
    # Rows that repeat both id and text are rare; without any, the texts pass one shuffle only.
    if not kept.filter("_rows > 1").isEmpty():
        left = left.unionByName(rows_of(kept.filter("_rows > 1")).dropDuplicates(["_sha"]))
    return left.select("_row.*")
