from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plugtide.functions.durable import intermediate_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    with intermediate_tables(session):
        yield session
    session.stop()


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


@pytest.fixture(scope="session")
def table(spark):
    """Small tables from rows and a DDL schema; times and dates are given as text."""

    def make(schema: str, rows: list[tuple]):
        kinds = [part.strip().split()[1] for part in schema.split(",")]
        convert = {"timestamp_ntz": ts, "date": day}
        return spark.createDataFrame(
            [tuple(convert.get(k, lambda v: v)(v) for k, v in zip(kinds, row)) for row in rows], schema
        )

    return make
