"""Which answer goes with which sale: tickets and answers by channel.

A survey answer belongs to a ticket sale of its city when it was given within a
few seconds after it.  A sale with several answers counts once for each, and
counts so in the totals too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.constants import ANSWER_WINDOW_SECONDS, NO_ANSWER, TICKET_CATEGORY, TOTAL
from turnstile.functions.keys import joined_text
from turnstile.functions.times import period_columns, round_to_second, time_text
from turnstile.operators.joins import interval_totals_left
from turnstile.operators.totals import labelled_totals


def attributed_checks(
    sales: DataFrame,
    answers: DataFrame,
    cities: DataFrame,
    period: str = "week",
    seconds: int = ANSWER_WINDOW_SECONDS,
    category: str = TICKET_CATEGORY,
    no_answer: str = NO_ANSWER,
    year_mode: str = "calendar",
) -> DataFrame:
    """One row per period, city, answer group and check, with tickets and answers.

    A check is what a city sold in one (rounded) second.  Sales of one instant
    are summed before the join, and so are equal answers of one instant: tickets
    then count once per equal answer, which is what joining the rows gives.
    Of the join only its sums are needed, so no pair of a sale and an answer is
    formed, however many share a city, an instant or an interval.
    """
    instants = (
        sales.where(F.col("item_category") == category)
        .groupBy("city", "sale_ts")
        .agg(F.sum("qty").alias("__qty"))
    )
    members = cities.select(F.col("name_en").alias("__en"), F.col("name_ru").cast("string").alias("__ru"))
    local = instants.join(members, F.col("city") == F.col("__en"), "inner")
    given = answers.groupBy(
        F.col("city").cast("string").alias("__city"), F.col("date").alias("__date"), F.col("value").alias("__value")
    ).agg(F.count(F.lit(1)).alias("__times"), F.max("qty").alias("__answers"))

    matched = interval_totals_left(
        local, given, {"__ru": "__city"}, "sale_ts", "__date", seconds, "__value", "__times", "__answers"
    )
    return (
        matched.groupBy(
            *period_columns("sale_ts", period, year_mode),
            F.col("city"),
            F.coalesce("__value", F.lit(no_answer)).alias("value_group"),
            round_to_second("sale_ts").alias("__second"),
        )
        .agg(
            F.sum(F.col("__qty") * F.coalesce("times", F.lit(1))).alias("qty_tickets"),
            F.max("best").alias("qty_answers"),
        )
        .withColumn("check_id", joined_text(time_text("__second"), "city", sep="_"))
        .drop("__second")
    )


def attribution_totals(checks: DataFrame, period: str = "week", total: str = TOTAL) -> DataFrame:
    """Tickets and answers by city and answer group, with all three kinds of total."""
    return labelled_totals(
        checks,
        ["year", period],
        ["city", "value_group"],
        {"total_tickets": "qty_tickets", "total_ads_qty": "qty_answers"},
        total,
    )
