"""Daily answer counts: one column per channel."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.constants import PIVOT_CHANNELS
from turnstile.operators.joins import rows_absent_from
from turnstile.operators.reshape import pivot_sums
from turnstile.operators.windows import latest_version


def latest_answers(versions: DataFrame) -> DataFrame:
    """The newest load of each (time, city, answer)."""
    newest = [F.col("load_dttm").desc_nulls_first(), F.col("qty").desc_nulls_last()]
    return latest_version(versions, ["date", "city", "value"], newest)


def daily_answers(
    versions: DataFrame, cities: DataFrame, columns: Mapping[str, str] = PIVOT_CHANNELS
) -> DataFrame:
    """Answers per day and English city name; a Russian name listed for no city has none."""
    # The versions of one city name are ranked before the names are looked up:
    # a name listed twice then keeps one row per key, as ranking the joined rows does.
    names = cities.groupBy(F.col("name_ru").alias("__ru")).agg(F.min("name_en").alias("name_en"))
    named = latest_answers(versions).join(names, F.col("city") == F.col("__ru"), "left")
    keys = [F.to_date("date").alias("day"), F.col("name_en").alias("city")]
    return pivot_sums(named.drop("city"), keys, "value", "qty", columns)


def new_daily_answers(daily: DataFrame, target: DataFrame, after: date | None = None) -> DataFrame:
    """Day and city rows later than a day that the target table does not hold."""
    if after is not None:
        daily = daily.where(F.col("day") > F.lit(after.isoformat()).cast("date"))
    return rows_absent_from(daily, target, ["day", "city"])
