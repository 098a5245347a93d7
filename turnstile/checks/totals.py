"""Totals, attribution, revenue and report checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.checks.registry import Tables, check
from turnstile.checks.views import (
    CHECK_CATEGORY,
    CHECK_REVENUE,
    CHECK_TOKEN,
    budgets,
    ctes,
    dates,
    offline,
    online,
    open_cities,
)
from turnstile.constants import ALL_CITIES, BUDGET_CHANNELS, MART_CHANNELS
from turnstile.functions.labels import decode
from turnstile.operators.quality import values_outside
from turnstile.plans.attribution import attributed_checks, attribution_totals
from turnstile.plans.budgets import budgets_by_week, prepared_budgets, prepared_budgets_month
from turnstile.plans.report import last_week, report_lines, report_rows
from turnstile.plans.revenue import (
    offline_by_week,
    revenue_by_source,
    week_over_week,
    weekly_receipt_revenue,
    weekly_revenue,
)

HOUR = 3600


def event_checks(t: Tables, period: str, year_mode: str = "calendar") -> DataFrame:
    """Purchases as sales, all other events of the same user within an hour as answers."""
    sales = t.events.where("event_type = 'purchase'").select(
        F.col("ts").alias("sale_ts"),
        F.col("event_type").alias("item_category"),
        F.round(F.col("value") * 100).cast("long").alias("qty"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("city"),
    )
    answers = t.events.where("event_type <> 'purchase'").select(
        F.col("ts").alias("date"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("value"),
        F.from_json("props", "k LONG")["k"].alias("qty"),
        F.col("user_id").alias("city"),
    )
    users = t.events.select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name_en"),
        F.col("user_id").alias("name_ru"),
    ).distinct()
    return attributed_checks(sales, answers, users, period, HOUR, "purchase", year_mode=year_mode)


CHECKS = """
    SELECT CAST(extract({year} FROM s.ts) AS BIGINT) AS year, CAST(extract({period} FROM s.ts) AS BIGINT) AS {period},
           'user ' || s.user_id AS city,
           coalesce(CASE WHEN a.event_type <> 'error' THEN a.event_type END, 'Без ответа') AS value_group,
           CAST(date_trunc('second', s.ts + INTERVAL 500 MILLISECOND) AS VARCHAR) || '_user ' || s.user_id AS check_id,
           CAST(sum(CAST(round(s.value * 100) AS BIGINT)) AS BIGINT) AS qty_tickets,
           CAST(max(CAST(json_extract_string(a.props, '$.k') AS BIGINT)) AS BIGINT) AS qty_answers
    FROM (SELECT * FROM events WHERE event_type = 'purchase') s
    LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') a
      ON s.user_id = a.user_id AND a.ts BETWEEN s.ts AND s.ts + INTERVAL 1 HOUR
    GROUP BY 1, 2, 3, 4, 5
"""


def _branches(source: str, period: str) -> str:
    """Four branches over checks: every detail and each kind of total."""
    sums = "CAST(sum(qty_tickets) AS BIGINT) AS total_tickets, CAST(sum(qty_answers) AS BIGINT) AS total_ads_qty"
    parts = []
    for city in ("city", "'Итого'"):
        for group in ("value_group", "'Итого'"):
            keys = ", ".join(["year", period] + [k for k in (city, group) if k != "'Итого'"])
            parts.append(
                f"SELECT year, {period}, {city} AS city, {group} AS value_group, {sums} FROM {source} GROUP BY {keys}"
            )
    return " UNION ALL ".join(parts)


WEEK_CHECKS = CHECKS.format(year="year", period="week")
MONTH_CHECKS = CHECKS.format(year="year", period="month")
ISO_CHECKS = CHECKS.format(year="isoyear", period="week")


@check(WEEK_CHECKS)
def check_rollup(t: Tables) -> DataFrame:
    return event_checks(t, "week")


@check(f"WITH c AS ({WEEK_CHECKS}) {_branches('c', 'week')}")
def attribution_cube_week(t: Tables) -> DataFrame:
    return attribution_totals(event_checks(t, "week"), "week")


@check(f"WITH c AS ({MONTH_CHECKS}) {_branches('c', 'month')}")
def attribution_cube_month(t: Tables) -> DataFrame:
    return attribution_totals(event_checks(t, "month"), "month")


@check(f"WITH c AS ({ISO_CHECKS}) {_branches('c', 'week')}")
def attribution_cube_iso_week(t: Tables) -> DataFrame:
    return attribution_totals(event_checks(t, "week", "iso"), "week")


PRICED = """
    SELECT date_from, city,
           CASE channel WHEN '2gis' THEN 'Карты 2gis' WHEN 'Инстаграм Посевы' THEN 'Инстаграм (соц.сеть)'
                        WHEN 'ВК ADS' THEN 'Вконтакте (соц.сеть)' WHEN 'Телеграм ADS' THEN 'Телеграм (мессенджер)'
           END AS channel,
           CASE WHEN channel = 'Инстаграм Посевы' THEN CAST(budget * 2 / 3 AS DECIMAL(24,6))
                ELSE CAST(budget AS DECIMAL(24,6)) END AS price
    FROM budgets
"""


def _budget_branches(source: str, period: list[str], measure: str) -> str:
    levels = {
        ("city", "channel"): "Детальные данные",
        ("city", "'Итого'"): "Итого по городу",
        ("'Итого'", "channel"): "Итого по каналу",
        ("'Итого'", "'Итого'"): "Общий итог",
    }
    parts = []
    for (city, channel), label in levels.items():
        keys = ", ".join(period + [k for k in (city, channel) if k != "'Итого'"])
        shown = ", ".join("CAST(date_from AS VARCHAR) AS date_from" if p == "date_from" else p for p in period)
        parts.append(
            f"SELECT {shown}, {city} AS city, {channel} AS channel, CAST(sum(price) AS DOUBLE) AS {measure}, "
            f"'{label}' AS aggregation_level FROM {source} "
            f"WHERE city IS NOT NULL AND channel IS NOT NULL GROUP BY {keys}"
        )
    return " UNION ALL ".join(parts)


@check(
    ctes("budgets", "dates")
    + f", priced AS ({PRICED}), dated AS (SELECT d.year, d.week, p.* FROM priced p JOIN dates d ON p.date_from = d.date) "
    + _budget_branches("dated", ["year", "week", "date_from"], "current_week")
)
def budget_cube_levels(t: Tables) -> DataFrame:
    return prepared_budgets(budgets(t), dates(t))


@check(
    ctes("budgets")
    + f", priced AS ({PRICED}), dated AS (SELECT CAST(extract(year FROM date_from) AS BIGINT) AS year, "
    "CAST(extract(month FROM date_from) AS BIGINT) AS month, p.* FROM priced p) "
    + _budget_branches("dated", ["year", "month"], "current_month")
)
def budget_cube_month(t: Tables) -> DataFrame:
    monthly = budgets(t).withColumn("date", F.concat(F.substring("dateFrom", 1, 7), F.lit("-01")))
    return prepared_budgets_month(monthly.drop("dateFrom"))


@check(
    ctes("budgets", "dates")
    + f""", priced AS ({PRICED})
SELECT d.year, d.week, p.city, p.channel, CAST(sum(p.price) AS DOUBLE) AS current_week
FROM priced p JOIN dates d ON p.date_from = d.date
WHERE p.city IS NOT NULL AND p.channel IS NOT NULL GROUP BY 1, 2, 3, 4
UNION ALL
SELECT d.year, d.week, 'Итого', 'Итого', CAST(sum(p.price) AS DOUBLE)
FROM priced p JOIN dates d ON p.date_from = d.date
WHERE p.city IS NOT NULL AND p.channel IS NOT NULL GROUP BY 1, 2
"""
)
def budget_per_week(t: Tables) -> DataFrame:
    """Several start dates of one week add up; details and the grand total."""
    weekly = budgets_by_week(prepared_budgets(budgets(t), dates(t)))
    is_total = F.col("city") == "Итого", F.col("channel") == "Итого"
    return weekly.where(is_total[0] == is_total[1])


@check("""
SELECT channel, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(budget) AS DOUBLE) AS total
FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Карты 2gis' WHEN '2-HIGH' THEN 'Инстаграм (соц.сеть)'
        WHEN '3-MEDIUM' THEN 'Вконтакте (соц.сеть)' WHEN '4-NOT SPECIFIED' THEN 'Телеграм (мессенджер)' END AS channel,
        CAST(o_totalprice AS DECIMAL(18,2)) AS budget FROM orders)
WHERE channel IS NULL OR channel = 'Телеграм (мессенджер)' GROUP BY 1
""")
def channels_dropped(t: Tables) -> DataFrame:
    """Budgets of channels that the mart has no row for: they count in totals only."""
    decoded = budgets(t).withColumn("channel", decode("channel", BUDGET_CHANNELS))
    return values_outside(decoded, "channel", MART_CHANNELS, "budget")


REVENUE_ROWS = """
    SELECT CAST(o.created_at AS DATE) AS day, c.name_en AS city, price_nominal - fee1 - fee2 AS amount,
           CASE WHEN ticket_type_name LIKE '%LOW%' THEN 0 ELSE 1 END AS tickets, 0 AS offline_tickets
    FROM online o JOIN cities c ON o.event_id = c.event_id WHERE status_name IN ('F', 'O')
    UNION ALL
    SELECT CAST(o.created_at AS DATE), 'Итого', sum(price_nominal - fee1 - fee2),
           sum(CASE WHEN ticket_type_name LIKE '%LOW%' THEN 0 ELSE 1 END), 0
    FROM online o JOIN cities c ON o.event_id = c.event_id WHERE status_name IN ('F', 'O')
    GROUP BY CAST(o.created_at AS DATE), ticket_type_name
    UNION ALL
    SELECT CAST(sale_ts AS DATE), city, revenue, CASE WHEN item_category = 'O' THEN qty ELSE 0 END,
           CASE WHEN item_category = 'O' THEN qty ELSE 0 END FROM offline
    UNION ALL
    SELECT CAST(sale_ts AS DATE), 'Итого', sum(revenue), sum(CASE WHEN item_category = 'O' THEN qty ELSE 0 END),
           sum(CASE WHEN item_category = 'O' THEN qty ELSE 0 END) FROM offline GROUP BY CAST(sale_ts AS DATE)
"""
REVENUE = f"""
    SELECT CAST(extract(year FROM day) AS BIGINT) AS year, CAST(extract(week FROM day) AS BIGINT) AS week, city,
           sum(amount) AS total_amount, CAST(sum(tickets) AS BIGINT) AS total_tickets,
           CAST(sum(offline_tickets) AS BIGINT) AS offline_tickets,
           CASE WHEN sum(offline_tickets) = 0 THEN 0
                ELSE CAST(sum(amount) AS DOUBLE) / CAST(sum(offline_tickets) AS DOUBLE) END AS sr_amount
    FROM ({REVENUE_ROWS}) GROUP BY 1, 2, 3
"""


def check_revenue(t: Tables) -> DataFrame:
    return weekly_revenue(
        online(t), offline(t), open_cities(t), CHECK_REVENUE, CHECK_TOKEN, CHECK_CATEGORY
    )


@check(
    ctes("cities", "online", "offline")
    + f"SELECT year, week, city, CAST(total_amount AS DOUBLE) AS total_amount, total_tickets, offline_tickets, sr_amount FROM ({REVENUE})"
)
def revenue_with_total(t: Tables) -> DataFrame:
    return check_revenue(t)


@check(
    ctes("cities", "online")
    + """
SELECT CAST(extract(year FROM day) AS BIGINT) AS year, CAST(extract(week FROM day) AS BIGINT) AS week, city,
       CAST(sum(amount) AS DOUBLE) AS total_amount
FROM (
  SELECT created_at AS day, c.name_en AS city, price_nominal - fee1 - fee2 AS amount
  FROM online o JOIN cities c ON o.event_id = c.event_id WHERE status_name IN ('F', 'O')
  UNION ALL
  SELECT created_at, 'Итого', price_nominal - fee1 - fee2
  FROM online o JOIN cities c ON o.event_id = c.event_id WHERE status_name IN ('F', 'O')
  UNION ALL
  SELECT l_shipdate, c.name_en, CAST(l_extendedprice AS DECIMAL(18,2))
  FROM lineitem JOIN cities c ON c.kkm_name = CAST(l_suppkey AS VARCHAR)
  UNION ALL
  SELECT l_shipdate, 'Итого', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem)
GROUP BY 1, 2, 3
"""
)
def receipt_revenue_with_total(t: Tables) -> DataFrame:
    receipts = t.lineitem.select(
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_suppkey").cast("string").alias("kkm"),
        F.col("l_linestatus").alias("item_category"),
        F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )
    return weekly_receipt_revenue(online(t), receipts, open_cities(t), CHECK_REVENUE, CHECK_TOKEN)


BY_SOURCE = """
    SELECT d.year, d.week, d.week_range, source, city, sum(amount) AS amount FROM (
      SELECT 'online' AS source, CAST(created_at AS DATE) AS day, c.name_en AS city, price_nominal - fee1 - fee2 AS amount
      FROM online o JOIN cities c ON o.event_id = c.event_id WHERE status_name IN ('F', 'O')
      UNION ALL
      SELECT 'online', CAST(created_at AS DATE), 'По всем городам', price_nominal - fee1 - fee2
      FROM online WHERE status_name IN ('F', 'O')
      UNION ALL SELECT 'offline', CAST(sale_ts AS DATE), city, revenue FROM offline
      UNION ALL SELECT 'offline', CAST(sale_ts AS DATE), 'По всем городам', revenue FROM offline) s
    LEFT JOIN dates d ON s.day = d.date GROUP BY 1, 2, 3, 4, 5
"""
CHANGES = f"""
    SELECT *, lag(amount) OVER (PARTITION BY city, source
                                ORDER BY year NULLS FIRST, week NULLS FIRST, week_range NULLS FIRST) AS previous
    FROM (SELECT year, week, week_range, city, source, amount FROM by_source
          UNION ALL SELECT year, week, week_range, city, 'all', sum(amount) FROM by_source GROUP BY 1, 2, 3, 4)
"""
CHANGE = "CAST(amount - previous AS DOUBLE) / nullif(CAST(previous AS DOUBLE), 0) * 100.0"
SOURCE_CTES = ctes("cities", "online", "offline", "dates") + f", by_source AS ({BY_SOURCE})"


def by_source(t: Tables) -> DataFrame:
    return revenue_by_source(online(t), offline(t), open_cities(t), dates(t), CHECK_REVENUE)


@check(
    SOURCE_CTES
    + " SELECT year, week, week_range, city, CAST(amount AS DOUBLE) AS amount FROM by_source "
    "WHERE city <> 'Итого' AND source = 'offline'"
)
def offline_revenue_by_week(t: Tables) -> DataFrame:
    return offline_by_week(by_source(t))


@check(
    SOURCE_CTES
    + f""", changes AS ({CHANGES})
SELECT year, week, week_range, city, source, CAST(amount AS DOUBLE) AS amount, CAST(previous AS DOUBLE) AS previous,
       {CHANGE} AS change_percent FROM changes
"""
)
def wow_change(t: Tables) -> DataFrame:
    return week_over_week(by_source(t)).select(
        "year", "week", "week_range", "city", "source", "amount", "previous", "change_percent"
    )


REPORT = (
    SOURCE_CTES
    + f""", changes AS ({CHANGES}),
week AS (
  SELECT city AS sklad, week_range, source, CAST(round_even(CAST(amount AS DOUBLE), 0) AS BIGINT) AS a,
         CAST(round_even({CHANGE}, 0) AS BIGINT) AS c
  FROM changes WHERE year = 2001 AND week = 20),
wide AS (
  SELECT sklad, min(week_range) AS week_range,
         max(CASE WHEN source = 'all' THEN a END) AS all_amount,
         coalesce(max(CASE WHEN source = 'online' THEN a END), 0) AS online_amount,
         coalesce(max(CASE WHEN source = 'offline' THEN a END), 0) AS offline_amount,
         max(CASE WHEN source = 'all' THEN c END) AS all_change,
         max(CASE WHEN source = 'online' THEN c END) AS online_change,
         max(CASE WHEN source = 'offline' THEN c END) AS offline_change
  FROM week GROUP BY sklad HAVING max(CASE WHEN source = 'all' THEN a END) IS NOT NULL)
"""
)


def _sql_line(source: str, short: str) -> str:
    c = f"{source}_change"
    return (
        f"CASE WHEN {c} > 0 THEN '🟢' WHEN {c} < 0 THEN '🔴' ELSE '' END || ' {short}: ' "
        f"|| replace(format('{{:,}}', {source}_amount), ',', ' ') || ' (' "
        f"|| coalesce(CASE WHEN {c} > 0 THEN '+' ELSE '' END || {c} || '%', '—') || ')'"
    )


@check(REPORT + " SELECT * FROM wide")
def report_rows_by_city(t: Tables) -> DataFrame:
    return report_rows(last_week(week_over_week(by_source(t)), 2001, 20))


@check(
    REPORT
    + f"""
SELECT CASE WHEN sklad = 'По всем городам' THEN 1 ELSE 2 END AS block, lower(sklad) AS city_order, line, text FROM (
  SELECT sklad, 0 AS line, CASE WHEN sklad = 'По всем городам' THEN sklad || ':' ELSE sklad END AS text FROM wide
  UNION ALL SELECT sklad, 1, {_sql_line("all", "all")} FROM wide
  UNION ALL SELECT sklad, 2, {_sql_line("online", "on")} FROM wide
  UNION ALL SELECT sklad, 3, {_sql_line("offline", "off")} FROM wide
  UNION ALL SELECT sklad, 4, '' FROM wide)
UNION ALL SELECT 0, '', 0, 'Отчет по продажам за ' || min(week_range) FROM wide
UNION ALL SELECT 0, '', 1, ''
ORDER BY 1, 2, 3
"""
)
def report_text(t: Tables) -> DataFrame:
    return report_lines(report_rows(last_week(week_over_week(by_source(t)), 2001, 20), ALL_CITIES))


