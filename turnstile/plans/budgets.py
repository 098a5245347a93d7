"""Budget sheets to budgets per period, city and channel, with totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.constants import (
    BUDGET_CHANNELS,
    BUDGET_SHARES,
    CITY_RU_TO_EN,
    LEVEL_ALL,
    LEVEL_CHANNEL,
    LEVEL_CITY,
    LEVEL_DETAIL,
    MONTH_SHEET_SERVICE_COLUMNS,
    TOTAL,
    WEEK_SHEET_SERVICE_COLUMNS,
)
from turnstile.functions.keys import budget_key
from turnstile.functions.labels import decode
from turnstile.functions.numbers import budget_share
from turnstile.functions.times import loose_date, month_start_text, period_columns
from turnstile.operators.reshape import unpivot_numbers
from turnstile.operators.totals import labelled_totals


def weekly_budget_rows(sheet: DataFrame, cities: Mapping[str, str] = CITY_RU_TO_EN) -> DataFrame:
    """A wide weekly sheet (with its ``channel``) to keyed rows per city."""
    rows = unpivot_numbers(sheet, [*WEEK_SHEET_SERVICE_COLUMNS, "channel"], "__city", "budget")
    named = rows.select(
        "channel",
        F.col("Дата с").alias("dateFrom"),
        F.col("Дата по").alias("dateTo"),
        decode("__city", cities, keep_unknown=True).alias("city"),
        "budget",
    )
    return named.select(budget_key("dateFrom").alias("id"), *named.columns)


def monthly_budget_rows(sheet: DataFrame, cities: Mapping[str, str] = CITY_RU_TO_EN) -> DataFrame:
    """A wide monthly sheet to keyed rows; a month that cannot be read drops its row."""
    rows = unpivot_numbers(sheet, [*MONTH_SHEET_SERVICE_COLUMNS, "channel"], "__city", "budget")
    named = rows.select(
        "channel",
        month_start_text("month").alias("date"),
        decode("__city", cities, keep_unknown=True).alias("city"),
        "budget",
    ).where(F.col("date").isNotNull())
    return named.select(budget_key("date").alias("id"), *named.columns)


LEVELS = {
    ("city", "channel"): LEVEL_DETAIL,
    ("city",): LEVEL_CITY,
    ("channel",): LEVEL_CHANNEL,
    (): LEVEL_ALL,
}


def prepared_budgets(
    budgets: DataFrame,
    dates: DataFrame,
    channels: Mapping[str, str] = BUDGET_CHANNELS,
    shares: Mapping[str, tuple[int, int]] = BUDGET_SHARES,
    total: str = TOTAL,
) -> DataFrame:
    """Budgets by year, week, start date, city and survey channel, with totals.

    Sheet channels without a survey channel are left out.  Amounts are summed
    by the landed texts first, so that only distinct ones are parsed and joined
    to the calendar.
    """
    per_text = budgets.groupBy("dateFrom", "city", "channel").agg(
        F.sum(budget_share("budget", "channel", shares)).alias("amount")
    )
    per_start = per_text.select(
        loose_date("dateFrom").alias("date_from"),
        "city",
        decode("channel", channels).alias("channel"),
        "amount",
    ).where(F.col("city").isNotNull() & F.col("channel").isNotNull())
    calendar = dates.select(F.to_date("date").alias("__day"), "year", "week")
    dated = per_start.join(calendar, F.col("date_from") == F.col("__day"), "inner")
    return labelled_totals(
        dated, ["year", "week", "date_from"], ["city", "channel"], {"current_week": "amount"}, total, LEVELS
    )


def prepared_budgets_month(
    budgets: DataFrame,
    channels: Mapping[str, str] = BUDGET_CHANNELS,
    shares: Mapping[str, tuple[int, int]] = BUDGET_SHARES,
    total: str = TOTAL,
) -> DataFrame:
    """The same by year and month; the month is that of the budget's own date."""
    per_text = budgets.groupBy("date", "city", "channel").agg(
        F.sum(budget_share("budget", "channel", shares)).alias("amount")
    )
    month = per_text.select(
        *period_columns(loose_date("date"), "month"),
        "city",
        decode("channel", channels).alias("channel"),
        "amount",
    ).where(F.col("city").isNotNull() & F.col("channel").isNotNull() & F.col("year").isNotNull())
    return labelled_totals(
        month, ["year", "month"], ["city", "channel"], {"current_month": "amount"}, total, LEVELS
    )


def budgets_by_week(prepared: DataFrame) -> DataFrame:
    """One amount per week, city and channel, whatever the start dates."""
    return prepared.groupBy("year", "week", "city", "channel").agg(
        F.sum("current_week").alias("current_week")
    )
