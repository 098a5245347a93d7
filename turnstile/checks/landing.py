"""Landed files: tables written as CSV and JSON, then read by the readers and the runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile import jobs, schemas
from turnstile.checks.registry import Tables, check
from turnstile.checks.views import money
from turnstile.constants import ANSWER_HEADINGS, RECEIPT_HEADINGS
from turnstile.session import shared_folder
from turnstile.sources.landed import active_cities, read_answers, read_receipts
from turnstile.sources.tables import append_table, replace_table

LOADED = datetime(2025, 1, 1)


def _folder(t: Tables, purpose: str) -> str:
    return f"{shared_folder(t.spark)}/{purpose}-{uuid.uuid4().hex}"


def _csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def _receipts(t: Tables) -> DataFrame:
    """Order lines as landed receipts, all text, under the landed headings."""
    values = (
        F.date_format("l_shipdate", "dd.MM.yyyy HH:mm:ss"), F.col("l_returnflag"), F.col("l_suppkey"),
        F.concat(F.lit("Receipt, "), F.col("l_orderkey")), F.col("l_linestatus"), F.col("l_linenumber"),
        F.col("l_partkey"), F.col("l_quantity").cast("decimal(18,3)"), money("l_extendedprice"),
    )
    return t.lineitem.select(*[v.cast("string").alias(h) for h, v in zip(RECEIPT_HEADINGS, values, strict=True)])


@check("""
SELECT l_returnflag AS till, count(*) AS row_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS VARCHAR) AS qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS amount
FROM lineitem WHERE NOT (l_linenumber = 7 AND l_quantity > 25) GROUP BY 1
UNION ALL SELECT 'rejected: unreadable number', count(*), NULL, NULL FROM lineitem WHERE l_linenumber = 7 AND l_quantity > 25
""")
def landed_receipts(t: Tables) -> DataFrame:
    """CSV files of two orders of columns and with further ones; lines with a bad number become rejects."""
    path, rows = _folder(t, "receipts"), _receipts(t)
    number = F.col("`Запасы.Номенклатура.Код`").cast("int")
    _csv(rows.where(number <= 3), f"{path}/load=1")
    turned = [F.col(f"`{h}`") for h in reversed(RECEIPT_HEADINGS)]
    _csv(rows.where(number.between(4, 6)).select(F.lit("x").alias("Ещё"), *turned), f"{path}/load=2")
    bad = F.when(F.col("`Запасы.Количество`").cast("double") > 25, "many").otherwise(F.col("`Запасы.Количество`"))
    _csv(rows.where(number == 7).withColumn("Запасы.Количество", bad), f"{path}/load=3")
    taken, rejects = read_receipts(t.spark, path, LOADED, whole_files=False)
    sums = taken.groupBy(F.col("kkm").alias("till")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").cast("string").alias("qty"), F.sum("amount").cast("string").alias("amount")
    )
    lost = rejects.groupBy(F.concat(F.lit("rejected: "), F.col("reason")).alias("till")).agg(F.count(F.lit(1)).alias("row_count"))
    nothing = F.lit(None).cast("string")
    return sums.unionByName(lost.withColumns({"qty": nothing, "amount": nothing}))


@check("""
SELECT l_returnflag AS till, count(DISTINCT (l_shipdate, l_orderkey, l_linenumber)) AS receipt_count FROM lineitem GROUP BY 1
""")
def cancelled_receipts_run(t: Tables) -> DataFrame:
    """The run of cancelled receipts, twice over the same files: one row per key."""
    path, w = _folder(t, "receipts"), jobs.Warehouse(t.spark, _folder(t, "warehouse"))
    _csv(_receipts(t), path)
    for _ in range(2):
        jobs.load_cancelled_receipts(w, path, LOADED)
    return w.read("receipts_cancel").groupBy(F.col("kkm").alias("till")).agg(F.count(F.lit(1)).alias("receipt_count"))


@check("""
SELECT o_orderpriority AS value, count(*) AS row_count, CAST(sum(o_custkey % 9) AS BIGINT) AS qty,
       strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first_date FROM orders GROUP BY 1
""")
def landed_answers(t: Tables) -> DataFrame:
    path = _folder(t, "answers")
    values = (F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss"), F.col("o_orderpriority"), F.col("o_custkey") % 9, F.col("o_orderstatus"))
    _csv(t.orders.select(*[v.cast("string").alias(h) for h, v in zip(ANSWER_HEADINGS, values, strict=True)]), path)
    rows = read_answers(t.spark, path, LOADED).rows.where(F.col("file_name").endswith(".csv"))
    return rows.groupBy("value").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"), F.date_format(F.min("date"), "yyyy-MM-dd HH:mm:ss").alias("first_date")
    )


@check("""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'cancelled' ELSE 'paid' END AS status, count(*) AS order_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS amount FROM orders GROUP BY 1
""")
def newest_order_state(t: Tables) -> DataFrame:
    """Three landings of orders, the first loaded once more at the end: the newest file's state stays."""
    path, w = _folder(t, "orders"), jobs.Warehouse(t.spark, _folder(t, "warehouse"))
    replace_table(t.spark.createDataFrame([("x", "x", "77", "x", True)], schemas.CITIES), w.path("cities"))
    for landing, (name, divisor) in enumerate((("paid", 1), ("paid", 2), ("cancelled", 3))):
        document = F.struct(
            F.col("o_orderkey").cast("string").alias("id"), F.lit("1").alias("eventSessionId"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), F.struct(F.lit(name).alias("name")).alias("status"),
            F.struct(money("o_totalprice").cast("string").alias("amount")).alias("payment"),
        )
        t.orders.where(F.col("o_orderkey") % divisor == 0).select(F.to_json(document)).write.text(f"{path}/{landing}/event_id=77")
    for landing in (0, 1, 2, 0):
        jobs.load_orders(w, f"{path}/{landing}", LOADED)
    return w.read("online_sales").groupBy(F.col("status_name").alias("status")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("payment_amount").cast("string").alias("amount")
    )


@check("SELECT CAST(c_nationkey AS VARCHAR) AS event_id, c_name AS city FROM customer WHERE c_acctbal > 0")
def active_events(t: Tables) -> DataFrame:
    cities = t.customer.select(F.col("c_nationkey").cast("string").alias("event_id"), F.col("c_name").alias("name_en"), (F.col("c_acctbal") > 0).alias("is_active"))
    return active_cities(cities)


@check("SELECT o_custkey AS customer, min(o_orderkey) AS first_order FROM orders GROUP BY 1")
def append_then_anti_join(t: Tables) -> DataFrame:
    """A third of the customers is appended first, then all whom the table lacks."""
    path = _folder(t, "appended")
    first = t.orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.min("o_orderkey").alias("first_order"))
    append_table(first.where(F.col("customer") % 3 == 0), path)
    held = t.spark.read.parquet(path)
    append_table(first.join(held.select("customer"), "customer", "left_anti"), path)
    return t.spark.read.parquet(path)
