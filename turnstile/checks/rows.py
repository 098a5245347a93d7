"""Row-wise operators: projections, predicates, decoding, parsing, keys, fees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.checks.registry import Tables, check
from turnstile.checks.views import CHECK_REVENUE, money, online
from turnstile.functions.keys import content_key
from turnstile.functions.labels import counts_as_ticket, decode, first_match, quantity_if
from turnstile.functions.numbers import net_amount
from turnstile.functions.times import (
    day_first_timestamp,
    month_start_text,
    order_timestamp,
    till_timestamp,
)
from turnstile.sources.landed import clean_landed


@check("""
SELECT o_orderkey AS receipt_id, o_custkey AS buyer_id, o_totalprice AS amount,
       o_orderdate AS sale_date, o_orderpriority AS item_category
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderstatus <> 'P'
""")
def scan_clean_rename(t: Tables) -> DataFrame:
    headings = {
        "o_orderkey": "receipt_id",
        "o_custkey": "buyer_id",
        "o_totalprice": "amount",
        "o_orderdate": "sale_date",
        "o_orderpriority": "item_category",
    }
    open_orders = t.orders.where(F.col("o_orderstatus") != "P")
    return clean_landed(open_orders, headings, "o_totalprice").select(*headings.values())


@check("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' WHEN o_orderpriority = '2-HIGH' THEN 'soon' END
         AS urgency,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'other' END AS level
FROM orders
""")
def nation_decode(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        first_match("o_orderpriority", {"1-URGENT": "now", "2-HIGH": "soon"}).alias("urgency"),
        decode("o_orderstatus", {"F": "finished", "O": "open"}, keep_unknown=True).alias("status"),
        first_match("o_orderpriority", {"5-LOW": "low"}, "other").alias("level"),
    )


@check("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2))
            - CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       CAST(CASE WHEN p_name LIKE '%ring%' THEN 0 ELSE 1 END AS BIGINT) AS is_ticket,
       CAST(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END AS DOUBLE) AS offline_ticket
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag IN ('R', 'A')
""")
def status_net_amount(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag").isin("R", "A"))
    named = returned.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return named.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        net_amount(money("l_extendedprice"), money("l_discount"), money("l_tax")).alias("amount"),
        counts_as_ticket("p_name", "ring").alias("is_ticket"),
        quantity_if("l_linestatus", "O", "l_quantity").cast("double").alias("offline_ticket"),
    )


@check("""
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       sha256(CAST(l_shipdate AS VARCHAR) || CAST(l_suppkey AS VARCHAR) || CAST(l_orderkey AS VARCHAR)
              || CAST(l_partkey AS VARCHAR)) AS receipt_hash,
       sha256(l_returnflag || '_' || l_linestatus || '_' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR))
         AS budget_id
FROM lineitem
""")
def sha_keys(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        content_key("l_shipdate", "l_suppkey", "l_orderkey", "l_partkey").alias("receipt_hash"),
        content_key("l_returnflag", "l_linestatus", F.to_date("l_shipdate"), sep="_").alias("budget_id"),
    )


@check("""
SELECT o_orderkey, o_orderdate AS till_time, o_orderdate AS day_first_time,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderdate END AS order_time,
       CASE o_orderstatus WHEN 'P' THEN NULL
            WHEN 'F' THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS month_start
FROM orders
""")
def parse_dates(t: Tables) -> DataFrame:
    """Dates of the orders written as text in all landed shapes, and read back."""
    text = F.col("o_orderdate").cast("string")
    y, m, d, clock = text.substr(1, 4), text.substr(6, 2), text.substr(9, 2), text.substr(12, 8)
    dot = F.lit(".")
    dotted = F.concat(d, dot, m, dot, y)
    mixed = (
        F.when(F.col("o_orderstatus") == "P", F.concat(dotted, F.lit(" "), clock))
        .when(F.col("o_orderstatus") == "F", F.concat_ws("/", d, m, y))
        .otherwise(text)
    )
    suffix = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "+0300")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "-0300")
        .when(F.col("o_orderpriority") == "5-LOW", "Z")
        .otherwise("")
    )
    month = (
        F.when(F.col("o_orderstatus") == "P", F.concat(m, dot, y))
        .when(F.col("o_orderstatus") == "F", dotted)
        .otherwise(text.substr(1, 10))
    )
    return t.orders.select(
        "o_orderkey",
        till_timestamp(F.concat(dotted, F.lit(" "), clock)).alias("till_time"),
        day_first_timestamp(mixed).alias("day_first_time"),
        order_timestamp(F.concat(text.substr(1, 10), F.lit("T"), clock, suffix)).alias("order_time"),
        month_start_text(month).alias("month_start"),
    )


@check("""
SELECT event_id, created_at, status_name,
       CAST(price_nominal AS DOUBLE) AS price,
       CAST(price_nominal - fee1 - fee2 AS DOUBLE) AS net
FROM (
  SELECT o_custkey AS event_id, o_orderdate AS created_at, o_orderstatus AS status_name,
         CAST(o_totalprice AS DECIMAL(14,2)) AS price_nominal,
         CASE WHEN o_orderstatus IN ('F','P')
              THEN round(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.025 AS DECIMAL(4,3)), 2) ELSE 0 END AS fee1,
         CASE WHEN o_orderstatus IN ('F','P')
              THEN round(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.022 AS DECIMAL(4,3)), 2) ELSE 0 END AS fee2
  FROM orders)
WHERE status_name IN ('F', 'O')
""")
def net_of_fees(t: Tables) -> DataFrame:
    kept = online(t).where(F.col("status_name").isin(*CHECK_REVENUE))
    return kept.select(
        "event_id",
        "created_at",
        "status_name",
        F.col("price_nominal").alias("price"),
        net_amount("price_nominal", "timepad_commission", "acquiring_commission").alias("net"),
    )
