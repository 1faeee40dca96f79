"""Split in time order, encodings and interacting features. Train and test stay one table, told
apart by `is_train`; whatever is fitted is fitted on the rows where it is true."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugtide import config
from plugtide.config import Settings
from plugtide.functions.durable import durable
from plugtide.functions.lookups import attach


def sequential_split(df: DataFrame, group: str, ratio: float = 0.8) -> DataFrame:
    """Marks the first floor(n * ratio) rows of each group, in time order, as training rows."""
    rows = Window.partitionBy(group)
    ties = [c for c in ("day_period", "evse_uid", "location_name") if c in df.columns and c != group]
    position = F.row_number().over(rows.orderBy("session_date", *ties))
    size = F.count(F.lit(1)).over(rows)
    return (
        df.filter(F.col(group).isNotNull())
        .withColumn("is_train", position <= F.floor(size * F.lit(ratio)))
    )


def target_encode(
    df: DataFrame, columns: list[str], target: str, alpha: float = 10.0, means_from: DataFrame | None = None
) -> DataFrame:
    """Smoothed mean of the target per value, fitted on the training rows.

    Values that training has not seen get the overall mean on test rows; a missing value stays
    missing on training rows. `means_from` is a written table with the same rows to take the means from.
    """
    # One pass over the training rows serves the overall mean and every column.
    sums = durable(
        (df if means_from is None else means_from).filter("is_train").groupBy(*columns).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n")),
        "target-sums",
    )
    overall = sums.agg(F.try_divide(F.sum("_sum"), F.sum("_n"))).scalar()
    for column in columns:
        encoded = f"{column}_encoded"
        means = (
            sums.filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
            .select(
                column,
                F.when(F.col("_n") > 0, (F.col("_sum") + overall * alpha) / (F.col("_n") + alpha)).alias(encoded),
            )
        )
        df = attach(df, means, [column]).withColumn(
            encoded, F.when(F.col("is_train"), F.col(encoded)).otherwise(F.coalesce(encoded, overall))
        )
    return df


def ordinal(column: str, order: list[str]) -> Column:
    """Position of the value in its order; any other value fails the query."""
    position = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    unknown = F.concat(F.lit(f"Unknown value in {column}: "), F.coalesce(column, F.lit("NULL")))
    return F.when(position > 0, (position - 1).cast("int")).otherwise(F.raise_error(unknown).cast("int"))


def ordinal_encode(df: DataFrame, orders: dict[str, list[str]] | None = None) -> DataFrame:
    orders = config.ORDINAL_ORDERS if orders is None else orders
    return df.withColumns({f"{c}_encoded": ordinal(c, order) for c, order in orders.items()})


def label_encode(df: DataFrame, column: str = "daily_period_busyness_cat") -> DataFrame:
    """The label as 0 / 1 in the given order; a label outside it, NULL too, fails the query."""
    return df.withColumn("label", ordinal(column, config.BUSYNESS_ORDER))


def averaged_sources(shifted: dict[str, str]) -> list[str]:
    """The columns whose mean stands in for a shifted value that a first row has not."""
    return [s for s in shifted.values() if s not in ("holiday_period", "weekday_encoded")]


def shift_features(
    df: DataFrame,
    group: str,
    shifted: dict[str, str] | None = None,
    part: str = "is_train",
    means_from: DataFrame | None = None,
) -> DataFrame:
    """Values of the day before, per (group, period), train and test apart.

    First rows: the holiday flag wraps around to the group's last one, the weekday is counted
    back, anything else gets the mean of the whole train or test part. `means_from` is a written
    table with the same rows to take these means from.
    """
    shifted = config.SHIFTED if shifted is None else shifted
    rows = Window.partitionBy(part, group, "day_period").orderBy("session_date")
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    averaged = averaged_sources(shifted)
    if averaged:
        # Two rows, one per part.
        means = (df if means_from is None else means_from).groupBy(part).agg(*[F.avg(s).alias(f"_mean_{s}") for s in averaged])
        df = df.join(F.broadcast(means), part)

    columns = {}
    for name, source in shifted.items():
        before = F.lag(source).over(rows)
        if source == "holiday_period":
            first = F.coalesce(F.last(source).over(whole), F.lit(0))
        elif source == "weekday_encoded":
            first = F.pmod(F.col(source) - 1, F.lit(7))
        else:
            first = F.col(f"_mean_{source}")
        columns[name] = F.coalesce(before, first)
    return df.withColumns(columns).drop(*[f"_mean_{s}" for s in averaged])


def interaction_product(df: DataFrame, name: str, left: str, right: str) -> DataFrame:
    return df.withColumn(name, F.col(left) * F.col(right))


def interaction_difference(df: DataFrame, name: str, left: str, right: str) -> DataFrame:
    return df.withColumn(name, F.col(left) - F.col(right))


def drop_features(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def interactions(df: DataFrame, group: str, means_from: DataFrame | None = None) -> DataFrame:
    """Shifts, products and differences; the shifts themselves are dropped again."""
    df = shift_features(df, group, means_from=means_from)
    for name, (left, right) in config.PRODUCTS.items():
        df = interaction_product(df, name, left, right)
    for name, (left, right) in config.DIFFERENCES.items():
        df = interaction_difference(df, name, left, right)
    return drop_features(df, list(config.SHIFTED))


def training_matrix(df: DataFrame, settings: Settings) -> DataFrame:
    """The feature columns, the label and the train flag; needs an encoded label."""
    keys = [c for c in ("session_date", "day_period", settings.group) if c in df.columns]
    return df.select(*keys, *settings.features, "label", "is_train")
