"""The weekly mart: every city and channel in every week, with returns on budget."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.constants import MART_CHANNELS, RANK_LABELS, TOTAL
from turnstile.functions.labels import rank_label
from turnstile.functions.numbers import zero_safe_fraction
from turnstile.functions.times import calendar_year, iso_week
from turnstile.operators.joins import left_join_pairs, spine, to_spelling_pairs
from turnstile.operators.windows import (
    offsets,
    partition_max,
    rank_total_first,
    rolling_return,
    total_first,
    up_to_period,
)
from turnstile.plans.budgets import budgets_by_week

LAGS = {
    "channel_answers": (1,),
    "channel_budget": (1, 2, 3),
    "channel_tickets": (1, 2, 3),
    "city_tickets": (1, 2, 3),
    "city_revenue": (1, 2, 3),
}
CITY_WEEK = ["year", "week", "city_ru"]


def week_of(day: date) -> list[Column]:
    d = F.lit(day.isoformat()).cast("date")
    return [calendar_year(d), iso_week(d)]


def city_members(cities: DataFrame, total: str = TOTAL) -> DataFrame:
    """Distinct city names and the total as one more city."""
    listed = cities.select(F.col("name_ru").alias("city_ru"), F.col("name_en").alias("city_en")).distinct()
    return listed.unionByName(
        listed.sparkSession.range(1).select(F.lit(total).alias("city_ru"), F.lit(total).alias("city_en"))
    )


def mart_weeks(sales: DataFrame, as_of: date) -> DataFrame:
    """Weeks with sales, up to the current one."""
    return sales.where(up_to_period(["year", "week"], week_of(as_of))).select("year", "week").distinct()


def _with_revenue(rows: DataFrame, revenue: DataFrame) -> DataFrame:
    earned = revenue.select(
        F.col("year").alias("__ry"), F.col("week").alias("__rw"), F.col("city").alias("__rc"),
        "total_amount", "offline_tickets", "sr_amount",
    )
    same = (F.col("year") == F.col("__ry")) & (F.col("week") == F.col("__rw"))
    return rows.join(earned, same & (F.col("city_en") == F.col("__rc")), "left").drop(
        "__ry", "__rw", "__rc"
    )


def _with_sales(rows: DataFrame, sales: DataFrame) -> DataFrame:
    sold = sales.select(
        F.col("year").alias("__sy"), F.col("week").alias("__sw"), F.col("city").alias("__sc"),
        F.col("value_group").alias("__sg"), "total_tickets", "total_ads_qty",
    )
    same = (F.col("year") == F.col("__sy")) & (F.col("week") == F.col("__sw"))
    here = (F.col("city_en") == F.col("__sc")) & (F.col("channel") == F.col("__sg"))
    return rows.join(sold, same & here, "left").drop("__sy", "__sw", "__sc", "__sg")


def with_facts(
    rows: DataFrame, names: DataFrame, sales: DataFrame, budgets: DataFrame, revenue: DataFrame
) -> DataFrame:
    """Attributed tickets, budget and city revenue of each row; null where there are none.

    Budgets under either spelling of a city, and of several start dates, add up
    before the join, so no row of the spine is doubled.
    """
    keys, either = ["year", "week", "channel"], ("city_en", "city_ru")
    weekly = budgets_by_week(budgets).withColumnRenamed("city", "__budget_city")
    spent = (
        to_spelling_pairs(weekly, names, either, "__budget_city")
        .groupBy(*keys, "__a", "__b")
        .agg(F.sum("current_week").alias("current_week"))
    )
    return _with_revenue(left_join_pairs(_with_sales(rows, sales), spent, keys, either), revenue)


def channel_revenue(total: str) -> Column:
    """The city's revenue on the total channel, else tickets at the average check."""
    tickets = F.coalesce("total_tickets", F.lit(0)).cast("double")
    return F.when(F.col("channel") == total, F.col("total_amount").cast("double")).otherwise(
        tickets * F.col("sr_amount")
    )


def metrics(joined: DataFrame, total: str = TOTAL) -> DataFrame:
    """Channel and city measures and their ratios.

    The total channel takes the city's figures; its budget is the highest of
    the city and week, which is the total budget as no budget is negative.
    """
    is_total = F.col("channel") == total
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    base = joined.withColumns(
        {
            "__tickets": zero("total_tickets"),
            "__ads": zero("total_ads_qty"),
            "__budget": zero("current_week"),
        }
    )
    base = base.withColumns(
        {
            "city_answers": partition_max("__ads", CITY_WEEK),
            "city_budget": partition_max("__budget", CITY_WEEK),
        }
    )
    base = base.withColumns(
        {
            "__revenue": channel_revenue(total),
            "__sold": F.when(is_total, F.col("offline_tickets")).otherwise(F.col("__tickets")),
            "channel_answers": F.col("__ads"),
            "channel_budget": F.when(is_total, F.col("city_budget")).otherwise(F.col("__budget")),
        }
    )
    income = zero_safe_fraction("total_amount", "channel_budget")
    return base.select(
        *CITY_WEEK,
        "city_en",
        "channel",
        F.col("__revenue").alias("channel_revenue"),
        F.col("__sold").alias("channel_tickets"),
        "channel_answers",
        "channel_budget",
        zero("offline_tickets").alias("city_tickets"),
        zero("total_amount").alias("city_revenue"),
        "city_answers",
        "city_budget",
        zero_safe_fraction("__revenue", "offline_tickets").alias("revenue_per_city_ticket"),
        zero_safe_fraction("channel_answers", "city_answers").alias("answer_share"),
        zero_safe_fraction("total_amount", "offline_tickets").alias("city_average_check"),
        zero_safe_fraction("total_amount", "city_answers").alias("revenue_per_answer"),
        income.alias("budget_fulfilment"),
        F.when(is_total, income)
        .otherwise(zero_safe_fraction("__sold", "offline_tickets") * income)
        .alias("roas"),
    )


def with_history(base: DataFrame) -> DataFrame:
    """Offsets of one to three weeks and the rolling returns, in one window."""
    w = Window.partitionBy("city_ru", "channel").orderBy("year", "week", "city_en")
    lagged = {name: F.coalesce(c, F.lit(0)) for name, c in offsets(w, LAGS).items()}
    measures = ("channel_tickets", "city_tickets", "city_revenue", "channel_budget")
    returns = {f"roas_{n}": rolling_return(w, n, *measures) for n in (2, 4)}
    return base.withColumns({**lagged, **returns})


def in_last_full_week(as_of: date) -> Column:
    year, week = week_of(as_of - timedelta(weeks=1))
    return (F.col("year") == year) & (F.col("week") == week)


def city_ranks(members: DataFrame, weeks: DataFrame, revenue: DataFrame, as_of: date, total: str) -> DataFrame:
    """Rank of each city by the revenue it had the week before the last full week.

    A city has the same revenue on every channel, so its weeks are laid out
    without channels.
    """
    rows = _with_revenue(spine(members, weeks, ["year", "week"], [total]), revenue)
    w = Window.partitionBy("city_ru").orderBy("year", "week", "city_en")
    before = rows.withColumn("before", F.lag(F.coalesce("total_amount", F.lit(0))).over(w))
    per_city = before.where(in_last_full_week(as_of)).groupBy("city_ru").agg(F.max("before").alias("v"))
    return rank_total_first(per_city, "city_ru", "v", total, "city_rank").drop("v")


def channel_ranks(
    members: DataFrame,
    weeks: DataFrame,
    sales: DataFrame,
    revenue: DataFrame,
    as_of: date,
    channels: Sequence[str],
    total: str,
) -> DataFrame:
    """Rank of each channel in its city by its revenue in the last full week.

    Laid out for that week alone; the week's facts are picked at the scan.
    """
    last = weeks.where(in_last_full_week(as_of))
    rows = spine(members, last, ["year", "week"], channels)
    week_sales, week_revenue = (f.where(in_last_full_week(as_of)) for f in (sales, revenue))
    rows = _with_revenue(_with_sales(rows, week_sales), week_revenue)
    per_channel = rows.groupBy("city_ru", "channel").agg(F.max(channel_revenue(total)).alias("v"))
    return rank_total_first(per_channel, "channel", "v", total, "channel_rank", ["city_ru"]).drop("v")


def with_ranks(
    rows: DataFrame, by_city: DataFrame, by_channel: DataFrame, labels: Sequence[str]
) -> DataFrame:
    """City and channel ranks on every row, and the names labelled with them."""
    ranked = rows.join(by_city, "city_ru", "left").join(by_channel, ["city_ru", "channel"], "left")

    def labelled(rank: str, name: str) -> Column:
        return F.concat(rank_label(rank, labels), F.lit(". "), F.col(name))

    return ranked.withColumns(
        {
            "ranked_city": labelled("city_rank", "city_ru"),
            "ranked_channel": labelled("channel_rank", "channel"),
        }
    )


LAG_COLUMNS = [f"{name}_week_{n}" for name, lags in LAGS.items() for n in lags]
MART_COLUMNS = [
    "ranked_city", "ranked_channel", "year", "week", "channel_revenue", "channel_tickets",
    "channel_answers", "channel_budget", "city_tickets", "city_revenue", "city_answers",
    "city_budget", "revenue_per_city_ticket", "answer_share", "city_average_check",
    "revenue_per_answer", "budget_fulfilment", *LAG_COLUMNS, "roas", "roas_2", "roas_4",
]


def mart_order(total: str = TOTAL) -> list[Column]:
    """Newest week first, then totals, then by rank."""
    return [
        F.col("year").desc(),
        F.col("week").desc(),
        total_first("city_ru", total),
        F.col("city_rank").asc_nulls_last(),
        total_first("channel", total),
        F.col("channel_rank").asc_nulls_last(),
    ]


def weekly_mart(
    sales: DataFrame,
    budgets: DataFrame,
    revenue: DataFrame,
    cities: DataFrame,
    as_of: date,
    channels: Sequence[str] = MART_CHANNELS,
    labels: Sequence[str] = RANK_LABELS,
    total: str = TOTAL,
    ordered: bool = True,
) -> DataFrame:
    """One row per week, city and channel.

    ``sales`` are the attribution totals, ``budgets`` the prepared budgets and
    ``revenue`` the weekly revenue, all with their total rows.  They are used
    more than once, so hand over stored tables.  Facts arrive summed; the work
    here grows with weeks, cities and channels, and every city has equally many
    rows.
    """
    weeks, members = mart_weeks(sales, as_of), city_members(cities, total)
    rows = spine(members, weeks, ["year", "week"], channels, spread_by="city_ru")
    rows = with_history(metrics(with_facts(rows, members, sales, budgets, revenue), total))
    by_city = city_ranks(members, weeks, revenue, as_of, total)
    by_channel = channel_ranks(members, weeks, sales, revenue, as_of, channels, total)
    rows = with_ranks(rows, by_city, by_channel, labels)
    if ordered:
        rows = rows.orderBy(*mart_order(total))
    return rows.select(*MART_COLUMNS)
