"""Weekly revenue per city: online and offline, with a total row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.constants import (
    ADD_ON_TOKEN,
    ALL_CITIES,
    REVENUE_STATUSES,
    TICKET_CATEGORY,
    TOTAL,
)
from turnstile.functions.labels import counts_as_ticket, quantity_if
from turnstile.functions.numbers import fraction, net_amount, zero_guarded_fraction
from turnstile.functions.times import period_columns

MEASURES = ("total_amount", "total_tickets", "offline_tickets")


def _per_key(facts: DataFrame, ts: str, key: str, amount, tickets, offline, year_mode) -> DataFrame:
    """Weekly sums by the column that leads to the city: the one pass over the facts."""
    return facts.groupBy(*period_columns(ts, "week", year_mode), F.col(key).alias("__key")).agg(
        F.sum(amount).alias("total_amount"),
        F.sum(tickets).alias("total_tickets"),
        F.sum(offline).alias("offline_tickets"),
    )


def online_per_event(
    orders: DataFrame, statuses=REVENUE_STATUSES, token: str = ADD_ON_TOKEN, year_mode: str = "calendar"
) -> DataFrame:
    """Weekly net revenue and tickets per event, of orders that count as revenue."""
    amount = net_amount("price_nominal", "timepad_commission", "acquiring_commission")
    ticket = counts_as_ticket("ticket_type_name", token)
    paid = orders.where(F.col("status_name").isin(*statuses))
    return _per_key(paid, "created_at", "event_id", amount, ticket, F.lit(0), year_mode)


def offline_per_city(
    sales: DataFrame, category: str = TICKET_CATEGORY, year_mode: str = "calendar"
) -> DataFrame:
    tickets = quantity_if("item_category", category, "qty")
    return _per_key(sales, "sale_ts", "city", F.col("revenue"), tickets, tickets, year_mode)


def receipts_per_till(
    receipts: DataFrame, category: str = TICKET_CATEGORY, year_mode: str = "calendar"
) -> DataFrame:
    tickets = quantity_if("item_category", category, "qty")
    return _per_key(receipts, "sale_date", "kkm", F.col("amount"), tickets, tickets, year_mode)


def detail_and_total(
    per_key: DataFrame,
    cities: DataFrame | None,
    city_key: str | None,
    total: str,
    total_joins_cities: bool,
) -> DataFrame:
    """Weekly rows per city name and a total row.

    The total has its own rule: it either sums what the city join gives (a key
    listed for two cities counts twice, an unlisted one not at all) or all rows
    as they are.  Both use the same weekly sums, so the facts are read once.
    """
    return with_total(per_key, ["year", "week"], MEASURES, cities, city_key, total, total_joins_cities)


def with_total(
    per_key: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    cities: DataFrame | None,
    city_key: str | None,
    total: str,
    total_joins_cities: bool,
) -> DataFrame:
    """Each row of sums under its cities' names and under the total, in one pass: no branch reads the facts again.

    A key's cities are gathered first (the list of cities is a short dimension),
    so the join keeps one row per row.
    """
    if cities is None:
        named, names = per_key, F.array("__key")
    else:
        places = cities.where(F.col(city_key).isNotNull()).groupBy(F.col(city_key).alias("__place"))
        places = places.agg(F.collect_list(F.struct("name_en")).alias("__cities"))
        named = per_key.join(places, F.col("__key") == F.col("__place"), "left")
        names = F.coalesce(F.transform("__cities", lambda c: c["name_en"]), F.array().cast("array<string>"))
    totals = F.transform(names, lambda _: F.lit(total)) if total_joins_cities else F.array(F.lit(total))
    return named.select(*keys, F.explode(F.concat(names, totals)).alias("city"), *measures)


def _sum_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def weekly_revenue(
    orders: DataFrame,
    sales: DataFrame,
    cities: DataFrame,
    statuses=REVENUE_STATUSES,
    token: str = ADD_ON_TOKEN,
    category: str = TICKET_CATEGORY,
    total: str = TOTAL,
    year_mode: str = "calendar",
) -> DataFrame:
    """Revenue, tickets, offline tickets and average check by year, week and city."""
    online = detail_and_total(
        online_per_event(orders, statuses, token, year_mode), cities, "event_id", total, True
    )
    offline = detail_and_total(offline_per_city(sales, category, year_mode), None, None, total, True)
    summed = _sum_by(online.unionByName(offline), ["year", "week", "city"])
    return summed.withColumn("sr_amount", zero_guarded_fraction("total_amount", "offline_tickets"))


def weekly_receipt_revenue(
    orders: DataFrame,
    receipts: DataFrame,
    cities: DataFrame,
    statuses=REVENUE_STATUSES,
    token: str = ADD_ON_TOKEN,
    total: str = TOTAL,
) -> DataFrame:
    """Revenue only, straight from receipts: tills are looked up for the cities,
    while the total takes every receipt."""
    online = detail_and_total(online_per_event(orders, statuses, token), cities, "event_id", total, True)
    offline = detail_and_total(receipts_per_till(receipts), cities, "kkm_name", total, False)
    both = online.unionByName(offline)
    return both.groupBy("year", "week", "city").agg(F.sum("total_amount").alias("total_amount"))


def revenue_by_source(
    orders: DataFrame,
    sales: DataFrame,
    cities: DataFrame,
    dates: DataFrame,
    statuses=REVENUE_STATUSES,
    total: str = ALL_CITIES,
) -> DataFrame:
    """Amounts by calendar week, city and source (online, offline), with all cities.

    Rows are summed per day before the calendar is joined; a day the calendar
    lacks has no week.  The online total takes every paid order, listed or not.
    """
    amount = net_amount("price_nominal", "timepad_commission", "acquiring_commission")
    paid = orders.where(F.col("status_name").isin(*statuses))
    online = paid.groupBy(F.to_date("created_at").alias("day"), F.col("event_id").alias("__key")).agg(
        F.sum(amount).alias("amount")
    )
    offline = sales.groupBy(F.to_date("sale_ts").alias("day"), F.col("city").alias("__key")).agg(F.sum("revenue").alias("amount"))
    online = with_total(online, ["day"], ["amount"], cities, "event_id", total, False)
    offline = with_total(offline, ["day"], ["amount"], None, None, total, True)
    every = online.withColumn("source", F.lit("online")).unionByName(offline.withColumn("source", F.lit("offline")))
    per_day = every.groupBy("source", "day", "city").agg(F.sum("amount").alias("amount"))
    calendar = dates.select(F.to_date("date").alias("__day"), "year", "week", "week_range")
    dated = per_day.join(calendar, F.col("day") == F.col("__day"), "left")
    return dated.groupBy("year", "week", "week_range", "source", "city").agg(
        F.sum("amount").alias("amount")
    )


def offline_by_week(by_source: DataFrame, total: str = TOTAL) -> DataFrame:
    """One source's weeks without the total label."""
    wanted = (F.col("source") == "offline") & (F.col("city") != total)
    return by_source.where(wanted).select("year", "week", "week_range", "city", "amount")


def week_over_week(by_source: DataFrame) -> DataFrame:
    """Amount and change to the week before, in percent, per city and source.

    A third source, ``all``, sums the others.  The first week, and one after a
    week without revenue, has no change.
    """
    keys = ["year", "week", "week_range", "city"]
    sources = F.explode(F.array("source", F.lit("all"))).alias("source")
    every = by_source.select(*keys, sources, "amount").groupBy(*keys, "source").agg(F.sum("amount").alias("amount"))
    w = Window.partitionBy("city", "source").orderBy("year", "week", "week_range")
    previous = F.lag("amount").over(w)
    return every.withColumn("previous", previous).withColumn(
        "change_percent", fraction(F.col("amount") - F.col("previous"), "previous") * F.lit(100.0)
    )
