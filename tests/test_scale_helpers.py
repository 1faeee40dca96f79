"""The helpers that keep hot keys and whole-table orders distributed, against plain answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plugtide.functions.durable import below_warehouse
from plugtide.functions.lookups import attach
from plugtide.functions.ordered import previous_row, running_totals


def hot_facts(spark):
    """A third of the rows on one key, another on NULL, the rest on many keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 3 == 1, F.concat(F.lit("k"), (i % 1500).cast("string")))
    return spark.range(30000).select(i.alias("row"), key.alias("key"))


def answers(df):
    return sorted((r["row"], r["key"], r["n"]) for r in df.collect())


def test_attach_gives_the_plain_join_on_every_path(spark):
    facts = hot_facts(spark)
    counts = facts.groupBy("key").agg(F.count("*").alias("rows"), F.sum("row").alias("n"))
    plain = answers(facts.join(counts.drop("rows"), "key", "left"))
    assert len(plain) == 30000
    for bound in (1 << 20, 0):
        assert answers(attach(facts, counts, ["key"], "rows", broadcast_bytes=bound)) == plain
        assert answers(attach(facts, counts.drop("rows"), ["key"], broadcast_bytes=bound)) == plain


def test_attach_broadcasts_only_hot_keys_of_a_large_table(spark):
    facts = hot_facts(spark)
    counts = facts.groupBy("key").agg(F.count("*").alias("rows"), F.sum("row").alias("n"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        out = attach(facts, counts, ["key"], "rows", broadcast_bytes=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        # One hot key and one NULL key with a third each: spread, no partition holds a third.
        assert max(sizes) < 30000 / 3
    finally:
        for name in changed:
            spark.conf.unset(name)


def test_a_key_just_under_the_bound_leaves_partitions_even(spark):
    """With 8 partitions a key is hot beyond 1/32 of the rows; this one has a little less."""
    i = F.col("id")
    key = F.when(i % 33 == 0, "nearly hot").otherwise(F.concat(F.lit("k"), (i % 4001).cast("string")))
    facts = spark.range(60000).select(i.alias("row"), key.alias("key"))
    counts = facts.groupBy("key").agg(F.count("*").alias("rows"), F.sum("row").alias("n"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        out = attach(facts, counts, ["key"], "rows", broadcast_bytes=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1.5 * 60000 / 8
    finally:
        for name in changed:
            spark.conf.unset(name)


def test_running_totals_and_previous_row(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 11).alias("v"))
    rows = sorted((r["k"], r["v"]) for r in df.collect())
    total, expected = 0, []
    for k, v in reversed(rows):
        total += v
        expected.append((k, total))
    got = running_totals(df, "k", {"t": "v"}, descending=True)
    assert sorted((r["k"], r["t"]) for r in got.collect()) == sorted(expected)
    before = {r["k"]: r["p"] for r in previous_row(df, ["k"], {"p": "v"}).collect()}
    assert before == {k: (rows[i - 1][1] if i else None) for i, (k, _) in enumerate(rows)}


def test_a_machines_own_folder_is_no_shared_one():
    assert below_warehouse("file:/w", "local[8]") == "file:/w/_shared"
    assert below_warehouse("s3a://b/w/", "spark://host:7077") == "s3a://b/w/_shared"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            below_warehouse(warehouse, "local-cluster[3,2,3000]")
