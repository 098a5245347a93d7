"""The weekly report as rows and as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.constants import ALL_CITIES, REPORT_TITLE
from turnstile.functions.numbers import signed_percent, spaced_number, trend_mark, whole_half_even

SOURCES = ("all", "online", "offline")
SHORT = {"all": "all", "online": "on", "offline": "off"}


def last_week(changes: DataFrame, year: int | Column, week: int | Column) -> DataFrame:
    """The rows of one week, in the shape the report reads."""
    return changes.where((F.col("year") == year) & (F.col("week") == week)).select(
        "week_range", F.col("city").alias("sklad"), "source", "amount", "change_percent"
    )


def report_rows(week: DataFrame, all_cities: str = ALL_CITIES) -> DataFrame:
    """One row per city with amount and change of every source, in whole numbers.

    A city without an ``all`` row is left out; a missing source has amount 0
    and no change.  The all-cities row is always kept.
    """

    def of(source: str, column: Column) -> Column:
        return F.max(F.when(F.col("source") == source, column))

    amount, change = whole_half_even("amount"), whole_half_even("change_percent")
    sums = [of(s, amount).alias(f"{s}_amount") for s in SOURCES]
    changes = [of(s, change).alias(f"{s}_change") for s in SOURCES]
    wide = week.groupBy("sklad").agg(F.min("week_range").alias("week_range"), *sums, *changes)
    kept = wide.where(F.col("all_amount").isNotNull() | (F.col("sklad") == all_cities))
    filled = {f"{s}_amount": F.coalesce(f"{s}_amount", F.lit(0)) for s in SOURCES}
    return kept.withColumns(filled)


def report_lines(rows: DataFrame, all_cities: str = ALL_CITIES) -> DataFrame:
    """Lines in reading order: heading, all cities, then cities by lower-case name.

    Every row brings the heading along and one copy is kept, so the rows are
    computed once.
    """
    is_all = F.col("sklad") == all_cities

    def amount_line(source: str) -> Column:
        change = F.col(f"{source}_change")
        text = spaced_number(f"{source}_amount")
        return F.concat(
            trend_mark(change), F.lit(f" {SHORT[source]}: "), text, F.lit(" ("), signed_percent(change), F.lit(")")
        )

    def line(block: Column, city: Column, number: int, text: Column) -> Column:
        return F.struct(
            block.alias("block"),
            F.lower(city).alias("city_order"),
            city.alias("city"),
            F.lit(number).alias("line"),
            text.alias("text"),
        )

    none, block, city = F.lit(""), F.when(is_all, F.lit(1)).otherwise(F.lit(2)), F.col("sklad")
    heading = F.when(is_all, F.concat(city, F.lit(":"))).otherwise(city)
    texts = [heading, *[amount_line(s) for s in SOURCES], none]
    title = [F.concat(F.lit(REPORT_TITLE), "week_range"), none]
    lines = [line(F.lit(0), none, i, t) for i, t in enumerate(title)]
    lines += [line(block, city, i, t) for i, t in enumerate(texts)]
    place = ["block", "city_order", "city", "line"]
    once = rows.select(F.inline(F.array(*lines))).groupBy(*place).agg(F.min("text").alias("text"))
    return once.orderBy(*place).select("block", "city_order", "line", "text")
