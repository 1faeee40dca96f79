"""Reading the input tables, and tables written once and read again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugtide import schema
from plugtide.config import Settings
from plugtide.functions.durable import exists, remove


def load_sessions(spark: SparkSession, path: str, fmt: str = "csv", strict: bool = True) -> DataFrame:
    """The session log, with its time columns parsed; columns are taken by name.

    A cell that can not be read as its type fails the job with its column and value; with
    `strict=False` it counts as missing.
    """
    return _load(spark, path, fmt, schema.SESSIONS, strict)


def load_points(spark: SparkSession, path: str, fmt: str = "csv", strict: bool = True) -> DataFrame:
    """Point and type, the only two columns read from the point file."""
    return _load(spark, path, fmt, schema.POINTS, strict)


def _load(spark: SparkSession, path: str, fmt: str, fields: T.StructType, strict: bool) -> DataFrame:
    # Without inference the CSV reader only looks at the header here, and later parses no more
    # than the selected columns; the file may have others, in any order.
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = schema.require(reader.format(fmt).load(path), *fields.names)
    return df.select(*[_read_as(f, strict).alias(f.name) for f in fields])


def _read_as(field: T.StructField, strict: bool) -> Column:
    given = F.col(field.name)
    value = given.try_cast(field.dataType)
    if not strict:
        return value
    told = F.concat(F.lit(f"Unreadable value in {field.name}: "), given.cast("string"))
    return F.when(given.isNotNull() & value.isNull(), F.raise_error(told).cast(field.dataType)).otherwise(value)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_or_compute(
    spark: SparkSession,
    path: str,
    compute: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
    fingerprint: str | None = None,
) -> DataFrame:
    """The table at `path` if it is there whole; otherwise it is computed, written there and read.

    A table counts as whole only with the marker that Spark leaves when a write has ended; what an
    interrupted write left behind is replaced. With a `fingerprint` (see `settings_mark` and
    `table_mark`) only a table that was written under the same one is read back.
    """
    whole = exists(spark, f"{path.rstrip('/')}/_SUCCESS")
    if whole and (fingerprint is None or _manifest(spark, path).get(WHOLE) == fingerprint):
        return spark.read.parquet(path)
    written = write_table(compute(), path, partition_by)
    if fingerprint is not None:
        _write_manifest(spark, path, {WHOLE: fingerprint})
    return written


# The name of what holds for the whole table in its manifest; other names are those of buckets.
WHOLE = "whole"


def settings_mark(settings: Settings) -> str:
    """The same text for the same settings."""
    return hashlib.sha256(repr(sorted(asdict(settings).items())).encode()).hexdigest()


def table_mark(df: DataFrame) -> str:
    """The same text for the same rows, whatever their order: their number and the sum of their hashes."""
    return "-".join(str(v) for v in df.agg(*_marks(df)).first())


def bucket_marks(df: DataFrame, bucket: str) -> dict[int, str]:
    """The mark of each bucket's rows; one short row per bucket comes to the driver."""
    return {r[0]: f"{r[1]}-{r[2]}" for r in df.groupBy(bucket).agg(*_marks(df.drop(bucket))).collect()}


def _marks(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("_sum")]


def refresh(
    spark: SparkSession,
    path: str,
    fingerprint: str,
    marks: dict[int, str],
    compute: Callable[[list[int]], DataFrame],
    bucket: str = "bucket",
) -> DataFrame:
    """The table at `path`, partitioned by `bucket`, with only those buckets written anew whose mark has changed.

    `marks` tell what each bucket is made from, `fingerprint` what all of them are; under another
    fingerprint nothing of an earlier table is used. `compute` gives the rows of some buckets, with
    their `bucket` column. The manifest forgets a bucket before its files are touched and names
    it once they are written, so that an interrupted refresh is made up for by the next.
    """
    path = path.rstrip("/")
    kept = _manifest(spark, path)
    known = {int(k): v for k, v in kept.items() if k != WHOLE} if kept.get(WHOLE) == fingerprint else {}
    changed = sorted(b for b, mark in marks.items() if known.get(b) != mark)
    gone = sorted(set(known) - set(marks))
    if not known:
        remove(spark, path)
    if changed or gone:
        left = {str(b): mark for b, mark in known.items() if b in marks and b not in changed}
        if known:
            _write_manifest(spark, path, {WHOLE: fingerprint} | left)
        for b in gone:
            remove(spark, f"{path}/{bucket}={b}")
        if changed:
            writer = compute(changed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(bucket).parquet(path)
        _write_manifest(spark, path, {WHOLE: fingerprint} | {str(b): mark for b, mark in marks.items()})
    if not marks:
        return compute([]).drop(bucket)
    return spark.read.parquet(path).drop(bucket)


def _manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and marks; nothing if its write did not end."""
    folder = f"{path.rstrip('/')}/_manifest"
    if not exists(spark, f"{folder}/_SUCCESS"):
        return {}
    return {r["name"]: r["mark"] for r in spark.read.schema("name string, mark string").json(folder).collect()}


def _write_manifest(spark: SparkSession, path: str, marks: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(marks.items()), "name string, mark string")
    rows.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")


def write_results(results: dict[str, DataFrame], folder: str) -> None:
    """One table per name below `folder`."""
    for name, df in results.items():
        write_table(df, f"{folder.rstrip('/')}/{name}")


def read_results(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in names}
