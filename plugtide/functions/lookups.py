"""Lookups from fact rows to one-row-per-key tables that stay even when one key is very hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugtide.functions.durable import durable, durable_sized

# Tables whose files have up to this many bytes are broadcast.
BROADCAST_BYTES = 4 << 20
SPREAD = 4096


def attach(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    rows_per_key: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join `facts` to `table`, which has one row per key.

    The table is written, which tells its bytes. A small table is broadcast. A larger one is
    shuffled, and only its hot keys are broadcast: those with more fact rows than a quarter of an
    even partition, of which there are at most four per shuffle partition. Fact rows of a hot key are
    answered there and then pass the second join spread over all partitions, since they need no
    partner in it; all other keys are small against a partition.

    `rows_per_key` names a column of `table` with the number of fact rows of the key, for tables
    aggregated from the facts; it is not part of the result. Without it the facts are counted by
    key, but only when the table is large.
    """
    values = [c for c in table.columns if c not in keys and c != rows_per_key]
    own = [c for c in facts.columns if c not in values]
    table, size = durable_sized(table, "lookup")
    if size <= broadcast_bytes:
        small = F.broadcast(table.select(*keys, *values))
        return facts.select(*own).join(small, keys, "left").select(*own, *values)

    hot_share = 1 / (4 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if rows_per_key is None:
        counts = durable(facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
        hot_keys = counts.filter(F.col("_rows") > counts.agg(F.sum("_rows")).scalar() * hot_share)
        hot = table.join(F.broadcast(hot_keys.select(*keys)), keys, "left_semi")
    else:
        total = table.agg(F.sum(rows_per_key)).scalar()
        hot = table.filter(F.col(rows_per_key) > total * hot_share)

    hot = hot.select(*keys, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values])
    # Always 0, but not a literal: the optimizer would take a literal out of the join keys, and with
    # it the spread.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    cold = table.select(*keys, zero.alias("_slot"), *[F.col(v).alias(f"_cold_{v}") for v in values])
    return (
        facts.select(*own)
        .join(F.broadcast(hot), keys, "left")
        .withColumn("_slot", _slot(own, keys))
        .join(cold, [*keys, "_slot"], "left")
        .select(
            *own,
            *[
                F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v)
                for v in values
            ],
        )
    )


def _slot(columns: list[str], keys: list[str]) -> Column:
    """0 for rows that look for a partner, a spread of other numbers for rows that have none."""
    no_partner = F.coalesce(F.col("_hot"), F.lit(False))
    for key in keys:
        no_partner = no_partner | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*columns), F.lit(SPREAD)).cast("int") + 1
    return F.when(no_partner, spread).otherwise(F.lit(0))
