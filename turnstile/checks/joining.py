"""Joins: dimensions, intervals, either-name, spine, anti, unions, windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.checks.registry import Tables, check
from turnstile.checks.views import money
from turnstile.constants import RANK_LABELS, TOTAL
from turnstile.functions.labels import rank_label
from turnstile.functions.numbers import zero_safe_fraction
from turnstile.functions.times import calendar_year, iso_week, period_columns
from turnstile.operators.joins import (
    aggregate_then_join,
    interval_join_left,
    left_join_either,
    rows_absent_from,
    spine,
)
from turnstile.operators.reshape import pivot_sums
from turnstile.operators.windows import (
    latest_version,
    offsets,
    partition_max,
    rank_total_first,
    rolling_return,
    total_first,
    up_to_period,
)
from turnstile.plans.weekly import week_of

AS_OF = date(2001, 6, 15)


def weekly_by(t: Tables, place: str, *more) -> DataFrame:
    """Weekly order revenue and count by nation or region of the customer.

    Summed by nation key first; names join the sums.
    """
    extra = [c.alias(f"group_{i}") for i, c in enumerate(more)]
    names = [f"group_{i}" for i in range(len(more))]
    per_nation = aggregate_then_join(
        t.orders,
        t.customer.select("c_custkey", "c_nationkey"),
        "o_custkey",
        "c_custkey",
        [*period_columns("o_orderdate", "week"), *extra],
        ["year", "week", *names, "c_nationkey"],
        {"revenue": money("o_totalprice"), "order_count": F.lit(1)},
    )
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.groupBy("year", "week", *names, place).agg(
        F.sum("revenue").alias("revenue"), F.sum("order_count").alias("order_count")
    )


WEEKLY = """
    SELECT CAST(extract(year FROM o_orderdate) AS BIGINT) AS year,
           CAST(extract(week FROM o_orderdate) AS BIGINT) AS week, {place},
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, CAST(count(*) AS BIGINT) AS order_count
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3
"""
BY_NATION = WEEKLY.format(place="n_name")
BY_REGION = WEEKLY.format(place="r_name")


@check(f"SELECT year, week, n_name, CAST(revenue AS DOUBLE) AS revenue, order_count FROM ({BY_NATION})")
def dim_join_weekly(t: Tables) -> DataFrame:
    return weekly_by(t, "n_name")


@check("""
SELECT c_custkey, c_name, n_name, r_name FROM customer
LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
           WHERE r_name <> 'ASIA') ON c_nationkey = n_nationkey
""")
def left_dim_join(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name <> 'ASIA'")
    joined = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "c_name", "n_name", "r_name")


@check("""
SELECT c.event_id AS click_id, c.user_id, c.ts AS click_ts, p.event_id AS purchase_id,
       p.ts AS purchase_ts, p.value AS purchase_value
FROM (SELECT * FROM events WHERE event_type = 'click') c
LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
  ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 1 HOUR
""", "interval_join_left")
def interval_join_left_events(t: Tables) -> DataFrame:
    def of(kind: str, prefix: str) -> DataFrame:
        return t.events.where(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("user_id").alias(f"{prefix}_user"),
            F.col("ts").alias(f"{prefix}_ts"),
            F.col("value").alias(f"{prefix}_value"),
        )

    joined = interval_join_left(
        of("click", "click").drop("click_value"),
        of("purchase", "purchase"),
        {"click_user": "purchase_user"},
        "click_ts",
        "purchase_ts",
        3600,
    )
    return joined.drop("purchase_user").withColumnRenamed("click_user", "user_id")


@check(f"""
WITH facts AS ({BY_REGION}),
weeks AS (SELECT DISTINCT year, week FROM facts),
places AS (SELECT DISTINCT r_name FROM region UNION ALL SELECT 'Итого'),
kinds AS (SELECT DISTINCT o_orderpriority AS channel FROM orders),
by_kind AS (
    SELECT CAST(extract(year FROM o_orderdate) AS BIGINT) AS year,
           CAST(extract(week FROM o_orderdate) AS BIGINT) AS week, r_name, o_orderpriority AS channel,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4)
SELECT w.year, w.week, p.r_name, k.channel, CAST(coalesce(b.revenue, 0) AS DOUBLE) AS channel_revenue,
       CAST(coalesce(f.revenue, 0) AS DOUBLE) AS place_revenue,
       coalesce(CAST(b.revenue AS DOUBLE) / nullif(CAST(f.revenue AS DOUBLE), 0), 0) AS share
FROM weeks w CROSS JOIN places p CROSS JOIN kinds k
LEFT JOIN by_kind b ON w.year = b.year AND w.week = b.week AND p.r_name = b.r_name AND k.channel = b.channel
LEFT JOIN facts f ON w.year = f.year AND w.week = f.week AND p.r_name = f.r_name
""")
def spine_left_join(t: Tables) -> DataFrame:
    weekly = weekly_by(t, "r_name").select("year", "week", "r_name", F.col("revenue").alias("place_sum"))
    by_kind = weekly_by(t, "r_name", F.col("o_orderpriority")).select(
        "year", "week", "r_name", F.col("group_0").alias("channel"), F.col("revenue").alias("channel_sum")
    )
    places = t.region.select("r_name").distinct()
    places = places.unionByName(t.spark.range(1).select(F.lit(TOTAL).alias("r_name")))
    kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    weeks = t.orders.select(*period_columns("o_orderdate", "week"))
    rows = spine(places, weeks, ["year", "week"], kinds)
    joined = rows.join(by_kind, ["year", "week", "r_name", "channel"], "left").join(
        weekly, ["year", "week", "r_name"], "left"
    )
    return joined.select(
        "year",
        "week",
        "r_name",
        "channel",
        F.coalesce("channel_sum", F.lit(0)).alias("channel_revenue"),
        F.coalesce("place_sum", F.lit(0)).alias("place_revenue"),
        zero_safe_fraction("channel_sum", "place_sum").alias("share"),
    )


@check("""
WITH spent AS (
    SELECT CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) WHEN s_suppkey % 3 = 1 THEN n_name
                ELSE 'elsewhere' END AS place,
           n_regionkey AS region_key, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS budget
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT n.n_name, lower(n.n_name) AS spelling, n.n_regionkey AS region_key, s.place,
       CAST(s.budget AS DOUBLE) AS budget
FROM nation n LEFT JOIN spent s
  ON n.n_regionkey = s.region_key AND (n.n_name = s.place OR lower(n.n_name) = s.place)
""")
def or_key_join(t: Tables) -> DataFrame:
    nations = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("region_key"))
    place = (
        F.when(F.col("s_suppkey") % 3 == 0, F.lower("n_name"))
        .when(F.col("s_suppkey") % 3 == 1, F.col("n_name"))
        .otherwise("elsewhere")
    )
    spent = (
        t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(place.alias("place"), "region_key")
        .agg(F.sum(money("s_acctbal")).alias("budget"))
    )
    rows = nations.select("n_name", F.lower("n_name").alias("spelling"), "region_key")
    return left_join_either(rows, spent, ["region_key"], ("n_name", "spelling"), "place")


@check(f"""
SELECT year, week, n_name, CAST(revenue AS DOUBLE) AS revenue,
       CAST(max(revenue) OVER (PARTITION BY year, week) AS DOUBLE) AS best_of_week
FROM ({BY_NATION})
""", "partition_max")
def partition_max_weekly(t: Tables) -> DataFrame:
    return weekly_by(t, "n_name").select(
        "year", "week", "n_name", "revenue", partition_max("revenue", ["year", "week"]).alias("best_of_week")
    )


@check(f"""
SELECT year, week, n_name, CAST(revenue AS DOUBLE) AS revenue,
       CAST(lag(revenue, 1) OVER w AS DOUBLE) AS revenue_week_1,
       CAST(lag(revenue, 2) OVER w AS DOUBLE) AS revenue_week_2,
       CAST(lag(revenue, 3) OVER w AS DOUBLE) AS revenue_week_3,
       lag(order_count, 1) OVER w AS order_count_week_1
FROM ({BY_NATION}) WINDOW w AS (PARTITION BY n_name ORDER BY year, week)
""")
def lag_1_2_3(t: Tables) -> DataFrame:
    w = Window.partitionBy("n_name").orderBy("year", "week")
    lagged = offsets(w, {"revenue": (1, 2, 3), "order_count": (1,)})
    return weekly_by(t, "n_name").withColumns(lagged).drop("order_count")


@check(f"""
WITH x AS (
  SELECT year, week, n_name, order_count AS c, revenue AS r,
         lag(order_count, 1) OVER w AS c1, lag(order_count, 2) OVER w AS c2, lag(order_count, 3) OVER w AS c3,
         lag(revenue, 1) OVER w AS r1, lag(revenue, 2) OVER w AS r2, lag(revenue, 3) OVER w AS r3,
         total, lag(total, 1) OVER w AS t1, lag(total, 2) OVER w AS t2, lag(total, 3) OVER w AS t3
  FROM (SELECT *, CAST(sum(order_count) OVER (PARTITION BY year, week) AS BIGINT) AS total FROM ({BY_NATION}))
  WINDOW w AS (PARTITION BY n_name ORDER BY year, week))
SELECT year, week, n_name,
  coalesce(CAST(c + coalesce(c1,0) AS DOUBLE) / nullif(CAST(total + coalesce(t1,0) AS DOUBLE), 0), 0)
  * coalesce(CAST(r + coalesce(r1,0) AS DOUBLE) / nullif(CAST(c + coalesce(c1,0) AS DOUBLE), 0), 0) AS roas_2,
  coalesce(CAST(c + coalesce(c1,0) + coalesce(c2,0) + coalesce(c3,0) AS DOUBLE)
           / nullif(CAST(total + coalesce(t1,0) + coalesce(t2,0) + coalesce(t3,0) AS DOUBLE), 0), 0)
  * coalesce(CAST(r + coalesce(r1,0) + coalesce(r2,0) + coalesce(r3,0) AS DOUBLE)
             / nullif(CAST(c + coalesce(c1,0) + coalesce(c2,0) + coalesce(c3,0) AS DOUBLE), 0), 0) AS roas_4
FROM x
""")
def rolling_roas(t: Tables) -> DataFrame:
    weekly = weekly_by(t, "n_name")
    total = F.sum("order_count").over(Window.partitionBy("year", "week"))
    w = Window.partitionBy("n_name").orderBy("year", "week")
    names = ("order_count", "total", "revenue", "order_count")
    return weekly.withColumn("total", total).select(
        "year",
        "week",
        "n_name",
        rolling_return(w, 2, *names).alias("roas_2"),
        rolling_return(w, 4, *names).alias("roas_4"),
    )


NATION_TOTALS = f"""
    SELECT n_name, sum(revenue) AS revenue FROM ({BY_NATION}) GROUP BY n_name
    UNION ALL SELECT 'Итого', sum(revenue) FROM ({BY_NATION})
"""


def nation_totals(t: Tables) -> DataFrame:
    per_nation = weekly_by(t, "n_name").groupBy("n_name").agg(F.sum("revenue").alias("revenue"))
    whole = per_nation.agg(F.sum("revenue").alias("revenue")).select(F.lit(TOTAL).alias("n_name"), "revenue")
    return per_nation.unionByName(whole)


@check(f"""
SELECT n_name, CAST(revenue AS DOUBLE) AS revenue,
       CAST(row_number() OVER (ORDER BY CASE WHEN n_name = 'Итого' THEN 0 ELSE 1 END,
                               revenue DESC NULLS FIRST, n_name) AS BIGINT) AS city_rank
FROM ({NATION_TOTALS})
""", "rank_total_first")
def rank_total_first_nations(t: Tables) -> DataFrame:
    return rank_total_first(nation_totals(t), "n_name", "revenue", TOTAL, "city_rank")


@check(f"""
SELECT year, n_name, CAST(revenue AS DOUBLE) AS revenue,
       CAST(row_number() OVER (PARTITION BY year ORDER BY revenue DESC NULLS FIRST, n_name) AS BIGINT)
         AS channel_rank
FROM (SELECT year, n_name, sum(revenue) AS revenue FROM ({BY_NATION}) GROUP BY 1, 2)
""")
def rank_in_group(t: Tables) -> DataFrame:
    yearly = weekly_by(t, "n_name").groupBy("year", "n_name").agg(F.sum("revenue").alias("revenue"))
    return rank_total_first(yearly, "n_name", "revenue", TOTAL, "channel_rank", ["year"])


@check(f"""
WITH ranked AS (
  SELECT n_name, row_number() OVER (ORDER BY CASE WHEN n_name = 'Итого' THEN 0 ELSE 1 END,
                                    revenue DESC NULLS FIRST, n_name) AS r FROM ({NATION_TOTALS})),
labels AS (SELECT unnest(['a_0','a_1','b_2','c_3','d_4','e_5','f_6','g_7','h_8','i_9']) AS label,
                  unnest(range(1, 11)) AS num)
SELECT CAST(w.year AS BIGINT) AS year, w.week, CAST(w.revenue AS DOUBLE) AS revenue,
       coalesce(l.label, CAST(r.r AS VARCHAR)) || '. ' || w.n_name AS ranked_city
FROM ({BY_NATION}) w LEFT JOIN ranked r ON w.n_name = r.n_name LEFT JOIN labels l ON r.r = l.num
ORDER BY w.year DESC, w.week DESC, r.r
""", "rank_label")
def rank_label_sorted(t: Tables) -> DataFrame:
    """Ranks joined back to the weeks, labelled (ten labels, then numbers), sorted."""
    ranks = rank_total_first(nation_totals(t), "n_name", "revenue", TOTAL, "r").select("n_name", "r")
    rows = weekly_by(t, "n_name").join(ranks, "n_name", "left")
    text = F.concat(rank_label("r", RANK_LABELS[:10]), F.lit(". "), F.col("n_name"))
    ordered = rows.withColumn("ranked_city", text).orderBy(
        F.col("year").desc(), F.col("week").desc(), total_first("n_name", TOTAL), F.col("r").asc_nulls_last()
    )
    return ordered.select("year", "week", "revenue", "ranked_city")


@check(f"""
SELECT year, week, n_name, CAST(revenue AS DOUBLE) AS revenue,
       (year = extract(year FROM DATE '2001-06-15' - INTERVAL 7 DAY)
        AND week = extract(week FROM DATE '2001-06-15' - INTERVAL 7 DAY)) AS is_last_full_week
FROM ({BY_NATION})
WHERE year < 2001 OR (year = 2001 AND week <= extract(week FROM DATE '2001-06-15'))
""")
def row_value_as_of(t: Tables) -> DataFrame:
    last = F.date_sub(F.lit(AS_OF.isoformat()).cast("date"), 7)
    is_last = (F.col("year") == calendar_year(last)) & (F.col("week") == iso_week(last))
    kept = weekly_by(t, "n_name").where(up_to_period(["year", "week"], week_of(AS_OF)))
    return kept.select("year", "week", "n_name", "revenue", is_last.alias("is_last_full_week"))


@check("""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1
""", "latest_version")
def latest_version_events(t: Tables) -> DataFrame:
    newest = [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]
    latest = latest_version(t.events, ["user_id", "event_type"], newest)
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


EVENT_COLUMNS = {"view": "views", "click": "clicks", "purchase": "purchases", "signup": "signups"}
PIVOT_SQL = """
    SELECT CAST(ts AS DATE) AS day, user_id,
           CAST(sum(CASE WHEN event_type = 'view' THEN n ELSE 0 END) AS BIGINT) AS views,
           CAST(sum(CASE WHEN event_type = 'click' THEN n ELSE 0 END) AS BIGINT) AS clicks,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN n ELSE 0 END) AS BIGINT) AS purchases,
           CAST(sum(CASE WHEN event_type = 'signup' THEN n ELSE 0 END) AS BIGINT) AS signups
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n FROM events) GROUP BY 1, 2
"""


def daily_events(t: Tables) -> DataFrame:
    """Day and user rows with the sum of a number inside the JSON of the event."""
    inner = F.from_json("props", "k LONG")["k"]
    keys = [F.to_date("ts").alias("day"), F.col("user_id")]
    return pivot_sums(t.events.withColumn("n", inner), keys, "event_type", "n", EVENT_COLUMNS)


@check(f"SELECT CAST(day AS VARCHAR) AS day, user_id, views, clicks, purchases, signups FROM ({PIVOT_SQL})")
def pivot_event_types(t: Tables) -> DataFrame:
    return daily_events(t)


@check(f"""
SELECT CAST(day AS VARCHAR) AS day, user_id, views, clicks, purchases, signups FROM ({PIVOT_SQL}) g
WHERE day > DATE '2024-01-05' AND NOT EXISTS (
  SELECT 1 FROM events e
  WHERE e.event_type = 'purchase' AND CAST(e.ts AS DATE) = g.day AND e.user_id = g.user_id)
""")
def anti_existing_days(t: Tables) -> DataFrame:
    held = t.events.where("event_type = 'purchase'").select(F.to_date("ts").alias("day"), "user_id")
    later = daily_events(t).where(F.col("day") > F.lit("2024-01-05").cast("date"))
    return rows_absent_from(later, held, ["day", "user_id"])


@check("SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return (
        t.customer.select(F.col("c_nationkey").alias("nation_key"))
        .union(t.supplier.select("s_nationkey"))
        .distinct()
    )
