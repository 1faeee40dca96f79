"""Public holidays by country and year, from rules instead of a supplied table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: public holidays of a country as a whole --------------------------------------
# country, kind, and by kind: month and day (fixed); days after Easter Sunday (easter); month,
# weekday (1 is Monday) and which one of the month, -1 for the last (weekday). Then how many days
# later (earlier, if negative) it is also kept when it falls on a Saturday or a Sunday, and the
# years it is kept from and to.
ALWAYS = (1900, 2199)
RULES = [
    ("GB", "fixed", 1, 1, 0, 2, 1, *ALWAYS),
    ("GB", "easter", -2, 0, 0, 0, 0, *ALWAYS),
    ("GB", "easter", 1, 0, 0, 0, 0, *ALWAYS),
    ("GB", "weekday", 5, 1, 1, 0, 0, 1978, 2019),
    ("GB", "fixed", 5, 8, 0, 0, 0, 2020, 2020),
    ("GB", "weekday", 5, 1, 1, 0, 0, 2021, 2199),
    ("GB", "weekday", 5, 1, -1, 0, 0, 1971, 2011),
    ("GB", "fixed", 6, 4, 0, 0, 0, 2012, 2012),
    ("GB", "fixed", 6, 5, 0, 0, 0, 2012, 2012),
    ("GB", "weekday", 5, 1, -1, 0, 0, 2013, 2021),
    ("GB", "fixed", 6, 2, 0, 0, 0, 2022, 2022),
    ("GB", "fixed", 6, 3, 0, 0, 0, 2022, 2022),
    ("GB", "fixed", 9, 19, 0, 0, 0, 2022, 2022),
    ("GB", "fixed", 5, 8, 0, 0, 0, 2023, 2023),
    ("GB", "weekday", 5, 1, -1, 0, 0, 2023, 2199),
    ("GB", "weekday", 8, 1, -1, 0, 0, 1971, 2199),
    ("GB", "fixed", 12, 25, 0, 2, 2, *ALWAYS),
    ("GB", "fixed", 12, 26, 0, 2, 2, *ALWAYS),
    ("FR", "fixed", 1, 1, 0, 0, 0, *ALWAYS),
    ("FR", "easter", 1, 0, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 5, 1, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 5, 8, 0, 0, 0, 1982, 2199),
    ("FR", "easter", 39, 0, 0, 0, 0, *ALWAYS),
    ("FR", "easter", 50, 0, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 7, 14, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 8, 15, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 11, 1, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 11, 11, 0, 0, 0, *ALWAYS),
    ("FR", "fixed", 12, 25, 0, 0, 0, *ALWAYS),
    ("DE", "fixed", 1, 1, 0, 0, 0, *ALWAYS),
    ("DE", "easter", -2, 0, 0, 0, 0, *ALWAYS),
    ("DE", "easter", 1, 0, 0, 0, 0, *ALWAYS),
    ("DE", "fixed", 5, 1, 0, 0, 0, *ALWAYS),
    ("DE", "easter", 39, 0, 0, 0, 0, *ALWAYS),
    ("DE", "easter", 50, 0, 0, 0, 0, *ALWAYS),
    ("DE", "fixed", 10, 3, 0, 0, 0, 1990, 2199),
    ("DE", "fixed", 12, 25, 0, 0, 0, *ALWAYS),
    ("DE", "fixed", 12, 26, 0, 0, 0, *ALWAYS),
    ("NL", "fixed", 1, 1, 0, 0, 0, *ALWAYS),
    ("NL", "easter", -2, 0, 0, 0, 0, *ALWAYS),
    ("NL", "easter", 0, 0, 0, 0, 0, *ALWAYS),
    ("NL", "easter", 1, 0, 0, 0, 0, *ALWAYS),
    ("NL", "easter", 39, 0, 0, 0, 0, *ALWAYS),
    ("NL", "easter", 49, 0, 0, 0, 0, *ALWAYS),
    ("NL", "easter", 50, 0, 0, 0, 0, *ALWAYS),
    ("NL", "fixed", 12, 25, 0, 0, 0, *ALWAYS),
    ("NL", "fixed", 12, 26, 0, 0, 0, *ALWAYS),
    ("US", "fixed", 1, 1, 0, -1, 1, *ALWAYS),
    ("US", "weekday", 1, 1, 3, 0, 0, 1986, 2199),
    ("US", "weekday", 2, 1, 3, 0, 0, 1971, 2199),
    ("US", "weekday", 5, 1, -1, 0, 0, 1971, 2199),
    ("US", "fixed", 6, 19, 0, -1, 1, 2021, 2199),
    ("US", "fixed", 7, 4, 0, -1, 1, *ALWAYS),
    ("US", "weekday", 9, 1, 1, 0, 0, *ALWAYS),
    ("US", "weekday", 10, 1, 2, 0, 0, 1971, 2199),
    ("US", "fixed", 11, 11, 0, -1, 1, 1978, 2199),
    ("US", "weekday", 11, 4, 4, 0, 0, 1942, 2199),
    ("US", "fixed", 12, 25, 0, -1, 1, *ALWAYS),
]
FIELDS = ["country", "kind", "a", "b", "c", "saturday", "sunday", "since", "until"]
COUNTRIES = sorted({rule[0] for rule in RULES})


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter, by the age of the moon and the Sunday after it is full."""

    def div(x: Column, y: int) -> Column:
        return F.floor(x / y).cast("int")

    golden, century = year % 19, div(year, 100)
    skipped = century - div(century, 4) - div(8 * century + 13, 25)
    age = (skipped + 19 * golden + 15) % 30
    moon = age - div(age, 28) * (1 - div(age, 28) * div(29 / (age + 1), 1) * div(21 - golden, 11))
    weekday = (year + div(year, 4) + moon + 2 - century + div(century, 4)) % 7
    days = moon - weekday
    month = 3 + div(days + 40, 44)
    return F.make_date(year, month, days + 28 - 31 * div(month, 4))


def _nth_weekday(year: Column) -> Column:
    """The c-th weekday b of month a, or the last if c is negative."""
    first = F.make_date(year, F.col("a"), F.lit(1))
    wanted = F.col("b") - 1
    counted = F.date_add(first, (F.pmod(wanted - F.weekday(first), F.lit(7)) + 7 * (F.col("c") - 1)).cast("int"))
    end = F.last_day(first)
    return F.when(F.col("c") > 0, counted).otherwise(F.date_sub(end, F.pmod(F.weekday(end) - wanted, F.lit(7)).cast("int")))


def holiday_calendar(spark: SparkSession, years: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Rows (country, holiday_date) for each distinct whole number in the one column of `years`.

    A holiday on a weekend is in the table, and so is the day it is kept on instead. Covers the
    `COUNTRIES` with their nation-wide holidays; a country without rules raises an error.
    """
    unknown = sorted(set(countries or []) - set(COUNTRIES))
    if unknown:
        raise ValueError(f"No holiday rules for {', '.join(unknown)}; there are some for {', '.join(COUNTRIES)}")
    kept = [r for r in RULES if countries is None or r[0] in countries]
    rules = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(FIELDS, r)]) for r in kept])
    (name,) = years.columns
    year = F.col("year")
    dated = (
        years.select(F.col(name).cast("int").alias("year")).filter("year IS NOT NULL").distinct()
        .select("year", F.inline(rules))
        .filter(year.between(F.col("since"), F.col("until")))
        .withColumn(
            "day",
            F.when(F.col("kind") == "fixed", F.make_date(year, F.when(F.col("kind") == "fixed", F.col("a")), F.greatest("b", F.lit(1))))
            .when(F.col("kind") == "easter", F.date_add(easter_sunday(year), F.col("a")))
            .otherwise(_nth_weekday(year)),
        )
    )
    moved = F.when(F.weekday("day") == 5, F.col("saturday")).when(F.weekday("day") == 6, F.col("sunday")).otherwise(F.lit(0))
    days = dated.withColumn("holiday_date", F.explode(F.array(F.col("day"), F.date_add("day", moved))))
    return days.select("country", "holiday_date").distinct()


def session_years(sessions: DataFrame, radius_days: int) -> DataFrame:
    """The years of the sessions' starts, and those within the radius of them."""
    start = F.to_date("started_at")
    reached = F.array(F.year(F.date_sub(start, radius_days)), F.year(F.date_add(start, radius_days)))
    return sessions.select(F.explode(reached).alias("year")).filter("year IS NOT NULL").distinct()
