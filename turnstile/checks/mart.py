"""The weekly mart from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnstile.checks.joining import AS_OF
from turnstile.checks.registry import Tables, check
from turnstile.checks.totals import PRICED, REVENUE, check_revenue
from turnstile.checks.views import (
    CHECK_CATEGORY,
    answers,
    budgets,
    city_names,
    ctes,
    dates,
    offline,
    open_cities,
)
from turnstile.constants import MART_CHANNELS, RANK_LABELS
from turnstile.plans.attribution import attributed_checks, attribution_totals
from turnstile.plans.budgets import prepared_budgets
from turnstile.plans.weekly import MART_COLUMNS, weekly_mart
from turnstile.sources.tables import hand_over_all

CHECKS = """
    SELECT CAST(extract(year FROM s.sale_ts) AS BIGINT) AS year, CAST(extract(week FROM s.sale_ts) AS BIGINT) AS week,
           c.name_en AS city, coalesce(a.value, 'Без ответа') AS value_group,
           CAST(date_trunc('second', s.sale_ts + INTERVAL 500 MILLISECOND) AS VARCHAR) || '_' || s.city AS check_id,
           sum(s.qty) AS qty_tickets, max(a.qty) AS qty_answers
    FROM offline s JOIN city_names c ON s.city = c.name_en
    LEFT JOIN answers a ON c.name_ru = a.city AND a.date BETWEEN s.sale_ts AND s.sale_ts + INTERVAL 8 SECOND
    WHERE s.item_category = 'O' GROUP BY 1, 2, 3, 4, 5
"""
SALES = """
    SELECT year, week, city, value_group, CAST(sum(qty_tickets) AS BIGINT) AS total_tickets,
           CAST(sum(qty_answers) AS BIGINT) AS total_ads_qty FROM checks GROUP BY 1, 2, 3, 4
    UNION ALL SELECT year, week, city, 'Итого', CAST(sum(qty_tickets) AS BIGINT), CAST(sum(qty_answers) AS BIGINT)
    FROM checks GROUP BY 1, 2, 3
    UNION ALL SELECT year, week, 'Итого', value_group, CAST(sum(qty_tickets) AS BIGINT), CAST(sum(qty_answers) AS BIGINT)
    FROM checks GROUP BY 1, 2, 4
    UNION ALL SELECT year, week, 'Итого', 'Итого', CAST(sum(qty_tickets) AS BIGINT), CAST(sum(qty_answers) AS BIGINT)
    FROM checks GROUP BY 1, 2
"""
WEEK_BUDGETS = """
    SELECT year, week, city, channel, sum(price) AS current_week FROM dated GROUP BY 1, 2, 3, 4
    UNION ALL SELECT year, week, city, 'Итого', sum(price) FROM dated GROUP BY 1, 2, 3
    UNION ALL SELECT year, week, 'Итого', channel, sum(price) FROM dated GROUP BY 1, 2, 4
    UNION ALL SELECT year, week, 'Итого', 'Итого', sum(price) FROM dated GROUP BY 1, 2
"""


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _quotient(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


def _window_sum(name: str, rows: int) -> str:
    lags = [f"coalesce({name}, 0)"] + [f"coalesce(lag({name}, {n}) OVER w, 0)" for n in range(1, rows)]
    return "(" + " + ".join(lags) + ")"


def _return(rows: int) -> str:
    return (
        _quotient(_window_sum("channel_tickets", rows), _window_sum("city_tickets", rows))
        + " * "
        + _quotient(_window_sum("city_revenue", rows), _window_sum("channel_budget", rows))
    )


_LAGS = [("channel_answers", 1)] + [
    (name, n) for name in ("channel_budget", "channel_tickets", "city_tickets", "city_revenue") for n in (1, 2, 3)
]
_AS_DOUBLE = {"channel_budget", "channel_revenue", "city_revenue", "city_budget"} | {
    f"{name}_week_{n}" for name, n in _LAGS if name in ("channel_budget", "city_revenue")
}
_SHOWN = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _AS_DOUBLE else c for c in MART_COLUMNS[2:])

MART = (
    ctes("city_names", "cities", "online", "offline", "answers", "budgets", "dates")
    + f""", checks AS ({CHECKS}), sales AS ({SALES}), revenue AS ({REVENUE}),
dated AS (SELECT d.year, d.week, p.city, p.channel, p.price FROM ({PRICED}) p JOIN dates d ON p.date_from = d.date
          WHERE p.city IS NOT NULL AND p.channel IS NOT NULL),
week_budgets AS ({WEEK_BUDGETS}),
grid AS (
  SELECT p.year, p.week, c.name_ru AS city_ru, c.name_en AS city_en, ch.channel
  FROM (SELECT DISTINCT year, week FROM sales
        WHERE year < 2001 OR (year = 2001 AND week <= extract(week FROM DATE '2001-06-15'))) p
  CROSS JOIN (SELECT DISTINCT name_ru, name_en FROM city_names UNION ALL SELECT 'Итого', 'Итого') c
  CROSS JOIN (SELECT unnest({_listed(MART_CHANNELS)}) AS channel) ch),
joined AS (
  SELECT g.*, coalesce(f.total_tickets, 0) AS tickets, coalesce(f.total_ads_qty, 0) AS ads,
         coalesce(b.current_week, 0) AS budget, r.total_amount, r.offline_tickets, r.sr_amount,
         max(coalesce(f.total_ads_qty, 0)) OVER cw AS city_answers,
         max(coalesce(b.current_week, 0)) OVER cw AS city_budget
  FROM grid g
  LEFT JOIN sales f ON g.year = f.year AND g.week = f.week AND g.city_en = f.city AND g.channel = f.value_group
  LEFT JOIN week_budgets b ON g.year = b.year AND g.week = b.week AND g.channel = b.channel
       AND (g.city_en = b.city OR g.city_ru = b.city)
  LEFT JOIN revenue r ON g.year = r.year AND g.week = r.week AND g.city_en = r.city
  WINDOW cw AS (PARTITION BY g.year, g.week, g.city_ru)),
base AS (
  SELECT year, week, city_ru, channel,
         CASE WHEN channel = 'Итого' THEN CAST(total_amount AS DOUBLE)
              ELSE CAST(tickets AS DOUBLE) * sr_amount END AS channel_revenue,
         CASE WHEN channel = 'Итого' THEN offline_tickets ELSE tickets END AS channel_tickets,
         ads AS channel_answers, CASE WHEN channel = 'Итого' THEN city_budget ELSE budget END AS channel_budget,
         coalesce(offline_tickets, 0) AS city_tickets, coalesce(total_amount, 0) AS city_revenue,
         city_answers, city_budget, total_amount, offline_tickets
  FROM joined),
ratios AS (
  SELECT *, {_quotient("channel_revenue", "offline_tickets")} AS revenue_per_city_ticket,
         {_quotient("channel_answers", "city_answers")} AS answer_share,
         {_quotient("total_amount", "offline_tickets")} AS city_average_check,
         {_quotient("total_amount", "city_answers")} AS revenue_per_answer,
         {_quotient("total_amount", "channel_budget")} AS budget_fulfilment,
         CASE WHEN channel = 'Итого' THEN {_quotient("total_amount", "channel_budget")}
              ELSE {_quotient("channel_tickets", "offline_tickets")} * {_quotient("total_amount", "channel_budget")}
         END AS roas
  FROM base),
lagged AS (
  SELECT *, lag(city_revenue) OVER w AS before,
         {", ".join(f"coalesce(lag({c}, {n}) OVER w, 0) AS {c}_week_{n}" for c, n in _LAGS)},
         {_return(2)} AS roas_2, {_return(4)} AS roas_4
  FROM ratios WINDOW w AS (PARTITION BY city_ru, channel ORDER BY year, week)),
last_week AS (
  SELECT * FROM lagged WHERE year = extract(year FROM DATE '2001-06-15' - INTERVAL 7 DAY)
    AND week = extract(week FROM DATE '2001-06-15' - INTERVAL 7 DAY)),
city_ranks AS (
  SELECT city_ru, row_number() OVER (ORDER BY CASE WHEN city_ru = 'Итого' THEN 0 ELSE 1 END,
                                     v DESC NULLS FIRST, city_ru) AS city_rank
  FROM (SELECT city_ru, max(before) AS v FROM last_week GROUP BY 1)),
channel_ranks AS (
  SELECT city_ru, channel, row_number() OVER (PARTITION BY city_ru
           ORDER BY CASE WHEN channel = 'Итого' THEN 0 ELSE 1 END, v DESC NULLS FIRST, channel) AS channel_rank
  FROM (SELECT city_ru, channel, max(channel_revenue) AS v FROM last_week GROUP BY 1, 2)),
labels AS (SELECT unnest({_listed(RANK_LABELS)}) AS label, unnest(range(1, {len(RANK_LABELS) + 1})) AS num),
ranked AS (
  SELECT l.*, coalesce(lc.label, CAST(cr.city_rank AS VARCHAR)) || '. ' || l.city_ru AS ranked_city,
         coalesce(lh.label, CAST(hr.channel_rank AS VARCHAR)) || '. ' || l.channel AS ranked_channel
  FROM lagged l LEFT JOIN city_ranks cr ON l.city_ru = cr.city_ru
  LEFT JOIN channel_ranks hr ON l.city_ru = hr.city_ru AND l.channel = hr.channel
  LEFT JOIN labels lc ON cr.city_rank = lc.num LEFT JOIN labels lh ON hr.channel_rank = lh.num)
SELECT ranked_city, ranked_channel, {_SHOWN} FROM ranked
"""
)


def mart_sales(t: Tables) -> DataFrame:
    checks = attributed_checks(offline(t), answers(t), city_names(t), category=CHECK_CATEGORY)
    return attribution_totals(checks)


@check(MART, "weekly_mart")
def weekly_mart_of_tables(t: Tables) -> DataFrame:
    """Order lines as sales, orders as answers, budgets and online sales, nations as cities.

    The summed facts are stored and handed over, as the weekly run does.
    """
    sales, spent, revenue = hand_over_all(
        {
            "sales": mart_sales(t),
            "budgets": prepared_budgets(budgets(t), dates(t)),
            "revenue": check_revenue(t),
        }
    )
    return weekly_mart(sales, spent, revenue, city_names(t), AS_OF)


@check(
    ctes("city_names", "offline", "answers")
    + f", checks AS ({CHECKS}) {SALES}"
)
def attribution_same_instant(t: Tables) -> DataFrame:
    """All sales and answers fall on midnight: every instant is shared by many rows."""
    return mart_sales(t)
