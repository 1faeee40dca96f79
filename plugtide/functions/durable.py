"""Cutting lineage with a table in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The folders written by this Python process, until `drop_written` removes them.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors reach.

    It is the one that `spark.checkpoint.dir` or `setCheckpointDir` names, and otherwise lies below
    the session's warehouse. A warehouse in a machine's own file system is shared only where one
    process runs everything; elsewhere it raises an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        named = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = named.get() if named.isDefined() else below_warehouse(
            spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
        )
    return folder.rstrip("/")


def below_warehouse(warehouse: str, master: str) -> str:
    one_process = master == "local" or master.startswith("local[")
    if not one_process and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("Executors do not share the warehouse; set spark.checkpoint.dir to a folder that all of them reach")
    return f"{warehouse.rstrip('/')}/_shared"


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/plugtide/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


# Spark's setting by which a query's shuffle files go when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write `df` once and go on from the written table.

    Readers prune its columns and see its true size; a lost executor costs a re-read, not a re-run.
    With `tidy` the shuffle files of the write go when it is done, and not when the driver happens
    to collect its garbage.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true" if tidy else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def durable_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The written table, and the bytes of its files; no job counts anything."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    size = _file_system(spark, path).getContentSummary(_hadoop_path(spark, path)).getLength()
    return spark.read.schema(df.schema).parquet(path), int(size)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file is there, in any store that Spark reads."""
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes the folder or file, if it is there."""
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def drop_table(df: DataFrame) -> None:
    """Remove one table that `durable` wrote, when nothing reads it any more."""
    folders = {path.rsplit("/", 2)[-2] for path in df.inputFiles()}
    for path in [p for p in _written if p.rsplit("/", 1)[-1] in folders]:
        _written.remove(path)
        remove(df.sparkSession, path)


def drop_written(spark: SparkSession, since: int = 0) -> None:
    """Remove the intermediate tables written so far; results that read them must be done by then."""
    while len(_written) > since:
        remove(spark, _written.pop())


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Owns the tables written inside the block: they are gone after it."""
    before = len(_written)
    try:
        yield
    finally:
        drop_written(spark, before)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
