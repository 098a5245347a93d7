"""Ingest shapes and sinks: documents, sheets, keyed writes, streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.checks.joining import weekly_by
from turnstile.checks.registry import Tables, check
from turnstile.checks.views import answers, city_names, ctes, money
from turnstile.constants import PIVOT_CHANNELS
from turnstile.functions.keys import content_key
from turnstile.functions.labels import decode
from turnstile.functions.times import period_columns
from turnstile.operators.quality import ingest_summary, key_uniqueness, summary_totals
from turnstile.operators.reshape import pivot_sums, unpivot_numbers
from turnstile.plans.answers import daily_answers
from turnstile.plans.orders import order_lines, rows_of_order
from turnstile.session import shared_folder
from turnstile.sources.landed import parse_order_documents
from turnstile.sources.tables import (
    insert_if_absent,
    read_table,
    replace_periods,
    spread_if_few,
    upsert,
)
from turnstile.streaming.ingest import ingest_new_files, parquet_stream

STATUS = {"R": "paid", "A": "transfer_payment", "N": "cancelled"}


def order_documents(t: Tables) -> DataFrame:
    """Each order line as a nested order document in JSON text.

    It holds as many tickets as its line number, and none when the line is not
    returned.  The time comes with and without an offset, and in a form that
    must be refused.
    """
    lines = spread_if_few(t.lineitem)
    # ``inline`` makes these once a line; in the lambda they would be made once a ticket.
    texts = F.struct(
        F.col("l_shipdate").cast("string").alias("day"),
        money("l_extendedprice").alias("price"),
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_quantity").cast("string").alias("quantity"),
    )
    lines = lines.select("*", F.inline(F.array(texts)))
    day, price = F.col("day"), F.col("price")
    suffix = F.when(F.col("l_tax") == 0.08, "Z").when(F.col("l_linestatus") == "O", "+0300").otherwise("")
    tickets = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber")),
        lambda i: F.struct(
            i.cast("string").alias("id"),
            (price + i).cast("string").alias("price_nominal"),
            F.struct(
                F.col("part").alias("id"),
                F.concat(F.lit("type "), i.cast("string")).alias("name"),
                F.col("quantity").alias("price"),
            ).alias("ticket_type"),
        ),
    )
    document = F.struct(
        F.concat_ws("-", "l_orderkey", "part", "l_suppkey").alias("id"),
        F.col("l_linenumber").cast("string").alias("eventSessionId"),
        F.concat(F.substring(day, 1, 10), F.lit("T"), F.substring(day, 12, 8), suffix).alias("created_at"),
        F.struct(first_status().alias("name"), F.col("l_linestatus").alias("title")).alias("status"),
        F.struct(price.cast("string").alias("amount")).alias("payment"),
        F.when(F.col("l_returnflag") != "N", tickets).alias("tickets"),
    )
    return lines.select(F.to_json(document).alias("document"), F.col("l_suppkey").alias("event"))


def first_status():
    flag = F.col("l_returnflag")
    return F.when(flag == "R", STATUS["R"]).when(flag == "A", STATUS["A"]).otherwise(STATUS["N"])


LINES = """
    SELECT CAST(l_suppkey AS VARCHAR) AS event_id, l_orderkey || '-' || l_partkey || '-' || l_suppkey AS order_id,
           CAST(l_linenumber AS VARCHAR) AS event_session_id, l_shipdate AS created_at,
           CASE l_returnflag WHEN 'R' THEN 'paid' WHEN 'A' THEN 'transfer_payment' ELSE 'cancelled' END AS status_name,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_linenumber AS parts,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE i END AS i,
           l_partkey, l_quantity, l_returnflag
    FROM lineitem, LATERAL (SELECT unnest(generate_series(1, CASE WHEN l_returnflag = 'N' THEN 1 ELSE l_linenumber END)) AS i)
    WHERE l_tax <> 0.08
"""


@check(f"""
SELECT sha256(event_id || order_id || event_session_id || CAST(created_at AS VARCHAR) || coalesce(CAST(i AS VARCHAR), '')
              || CASE WHEN i IS NULL THEN '' ELSE CAST(l_partkey AS VARCHAR) END) AS order_hash,
       event_id, order_id, event_session_id, created_at, status_name,
       CAST(amount AS DOUBLE) AS payment_amount, coalesce(CAST(i AS VARCHAR), '') AS ticket_id,
       CASE WHEN i IS NULL THEN 0 ELSE CAST(amount + i AS DOUBLE) END AS price_nominal,
       CASE WHEN i IS NULL THEN '' ELSE 'type ' || i END AS ticket_type_name,
       CASE WHEN i IS NULL THEN 0 ELSE CAST(l_quantity AS DOUBLE) END AS ticket_price
FROM ({LINES})
""")
def explode_lines(t: Tables) -> DataFrame:
    lines = order_lines(parse_order_documents(order_documents(t), "document", "event"))
    return lines.select(
        "order_hash", F.col("event_id").cast("string").alias("event_id"), "order_id", "event_session_id",
        "created_at", "status_name", "payment_amount", "ticket_id", "price_nominal", "ticket_type_name",
        "ticket_price",
    )


@check(f"""
WITH cents AS (
  SELECT event_id, order_id, parts, i, status_name,
         CASE WHEN status_name = 'paid' THEN CAST(round(amount * 100, 0) AS BIGINT) ELSE 0 END AS a FROM ({LINES})),
fees AS (SELECT *, (a * 25 + 500) // 1000 AS s, (a * 22 + 500) // 1000 AS q FROM cents)
SELECT event_id, order_id, coalesce(CAST(i AS VARCHAR), '') AS ticket_id, status_name,
       CASE WHEN i IS NULL THEN s ELSE (2 * s + parts) // (2 * parts) END / 100.0 AS timepad_commission,
       CASE WHEN i IS NULL THEN q ELSE (2 * q + parts) // (2 * parts) END / 100.0 AS acquiring_commission
FROM fees
""")
def commission_split(t: Tables) -> DataFrame:
    lines = order_lines(parse_order_documents(order_documents(t), "document", "event"))
    return lines.select(
        F.col("event_id").cast("string").alias("event_id"),
        "order_id", "ticket_id", "status_name", "timepad_commission", "acquiring_commission",
    )


SUMMARY = """
    SELECT s_suppkey AS event_id, s_name AS city, coalesce(n, 0) AS orders_count, coalesce(m, 0) AS tickets_count,
           CASE WHEN n IS NULL THEN 'error' ELSE 'success' END AS status
    FROM supplier LEFT JOIN (
      SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n,
             CAST(sum(CASE WHEN l_tax = 0.08 THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE l_linenumber END) AS BIGINT) AS m
      FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey
"""


def supplier_summary(t: Tables) -> DataFrame:
    documents = parse_order_documents(order_documents(t), "document", "event")
    units = t.supplier.select(F.col("s_suppkey").alias("event_id"), F.col("s_name").alias("city"))
    return ingest_summary(units, "event_id", documents, "event_id", rows_of_order())


@check(SUMMARY, "ingest_summary")
def ingest_summary_suppliers(t: Tables) -> DataFrame:
    return supplier_summary(t)


@check(f"""
SELECT CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS success_count,
       CAST(count(*) FILTER (WHERE status <> 'success') AS BIGINT) AS error_count,
       CAST(sum(tickets_count) AS BIGINT) AS tickets_count FROM ({SUMMARY})
""")
def ingest_totals(t: Tables) -> DataFrame:
    return summary_totals(supplier_summary(t))


@check("""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_keys, sum(n) = count(*) AS is_unique
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
""", "key_uniqueness")
def key_uniqueness_lines(t: Tables) -> DataFrame:
    return key_uniqueness(t.lineitem, content_key("l_orderkey", "l_linenumber", sep="_"))


@check("""
SELECT o_orderkey, o_orderdate, CAST(o_totalprice + CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN
           CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END ELSE 0 END AS DOUBLE) AS o_totalprice,
       CASE WHEN o_orderdate < TIMESTAMP '1998-06-01' THEN 'kept'
            WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'updated' ELSE 'inserted' END AS origin
FROM orders
""")
def upsert_orders(t: Tables) -> DataFrame:
    """Orders up to 1998 as the table, orders from June 1998 on as a batch of up to two versions."""
    target = t.orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.lit("kept").alias("origin")
    )
    known = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    batch = (
        t.orders.where(F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp_ntz"))
        .withColumn("version", F.explode(F.when(F.col("o_orderstatus") == "F", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            "o_orderkey",
            "o_orderdate",
            (F.col("o_totalprice") + F.col("version")).alias("o_totalprice"),
            F.when(known, "updated").otherwise("inserted").alias("origin"),
            "version",
        )
    )
    return upsert(target, batch, ["o_orderkey"], [F.col("version").desc()])


@check("""
WITH target AS (SELECT o_orderkey AS order_key, o_orderdate AS day, 'order' AS origin FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM target UNION ALL
SELECT l_orderkey, min(l_shipdate), 'line' FROM lineitem
WHERE l_orderkey NOT IN (SELECT order_key FROM target) GROUP BY 1
""")
def insert_if_absent_orders(t: Tables) -> DataFrame:
    """Finished orders as the table; the first shipped line of an order it lacks is added."""
    target = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("day"), F.lit("order").alias("origin")
    )
    batch = t.lineitem.select(
        F.col("l_orderkey").alias("order_key"), F.col("l_shipdate").alias("day"), F.lit("line").alias("origin")
    )
    return insert_if_absent(target, batch, ["order_key"], [F.col("day").asc_nulls_last()])


REGIONS = {"AFRICA": "Африка", "AMERICA": "Америка", "ASIA": "Азия", "EUROPE": "Европа", "MIDDLE EAST": "Ближний Восток"}


@check("""
SELECT CAST(year AS VARCHAR) AS year, CAST(week AS VARCHAR) AS week, r_name AS city,
       CASE WHEN r_name = 'MIDDLE EAST' THEN CAST(floor(revenue) AS DOUBLE) ELSE CAST(revenue AS DOUBLE) END AS budget
FROM (SELECT extract(year FROM o_orderdate) AS year, extract(week FROM o_orderdate) AS week, r_name,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)
""")
def unpivot_budget(t: Tables) -> DataFrame:
    """Weekly revenue as a wide sheet, each region in its own number format, and read back."""
    weekly = weekly_by(t, "r_name")
    grouped = F.format_number("revenue", 2)
    plain = F.col("revenue").cast("decimal(18,2)").cast("string")
    text = (
        F.when(F.col("r_name") == "AFRICA", F.translate(plain, ".", ","))
        .when(F.col("r_name") == "AMERICA", grouped)
        .when(F.col("r_name") == "ASIA", F.translate(grouped, ",.", " ,"))
        .when(F.col("r_name") == "EUROPE", F.concat(F.lit(" "), plain))
        .otherwise(F.format_number(F.floor("revenue"), 0))
    )
    cells = [F.max(F.when(F.col("r_name") == r, text)).alias(name) for r, name in REGIONS.items()]
    sheet = weekly.groupBy(F.col("year").cast("string"), F.col("week").cast("string")).agg(*cells)
    long = unpivot_numbers(sheet, ["year", "week"], "city_ru", "budget")
    back = {v: k for k, v in REGIONS.items()}
    return long.select("year", "week", decode("city_ru", back, keep_unknown=True).alias("city"), "budget")


ANSWER_COLUMNS = ["Карты 2gis", "Инстаграм (соц.сеть)", "Вконтакте (соц.сеть)", "Смс", "Телевидение"]


@check(
    ctes("answers", "city_names")
    + """, versions AS (
  SELECT date, city, value, qty + 10 * k AS qty, date + k * INTERVAL 1 DAY AS load_dttm
  FROM answers, (SELECT unnest([0, 1]) AS k)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, city, value
             ORDER BY load_dttm DESC NULLS FIRST, qty DESC NULLS LAST) AS r FROM versions) WHERE r = 1)
SELECT CAST(CAST(date AS DATE) AS VARCHAR) AS day, name_en AS city, """
    + ", ".join(
        f"CAST(sum(CASE WHEN value = '{c}' THEN qty ELSE 0 END) AS BIGINT) AS \"{c}\"" for c in ANSWER_COLUMNS
    )
    + """
FROM latest LEFT JOIN city_names ON latest.city = city_names.name_ru GROUP BY CAST(date AS DATE), name_en
"""
)
def daily_answer_pivot(t: Tables) -> DataFrame:
    """Two loads of every answer; the newest counts; one column per channel."""
    versions = answers(t).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    versions = versions.select(
        "date",
        "city",
        "value",
        (F.col("qty") + 10 * F.col("k")).alias("qty"),
        (F.col("date") + F.make_dt_interval(F.col("k"))).alias("load_dttm"),
    )
    daily = daily_answers(versions, city_names(t), PIVOT_CHANNELS)
    return daily.select("day", "city", *[F.col(f"`{c}`") for c in ANSWER_COLUMNS])


def _run_folder(t: Tables, purpose: str) -> str:
    return f"{shared_folder(t.spark)}/{purpose}-{uuid.uuid4().hex}"


@check("""
SELECT CAST(extract(year FROM o_orderdate) AS BIGINT) AS year, CAST(extract(week FROM o_orderdate) AS BIGINT) AS week,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2
""")
def replace_period_tables(t: Tables) -> DataFrame:
    """Weekly sums stored by year, and the last years stored once more: no period doubles."""
    weekly = t.orders.groupBy(*period_columns("o_orderdate", "week")).agg(
        F.sum(money("o_totalprice")).alias("revenue")
    )
    path = _run_folder(t, "weekly")
    replace_periods(weekly, path, ["year"])
    replace_periods(weekly.where(F.col("year") >= 2000), path, ["year"])
    schema = T.StructType(
        [
            T.StructField("week", T.LongType()),
            T.StructField("revenue", weekly.schema["revenue"].dataType),
            T.StructField("year", T.LongType()),
        ]
    )
    return read_table(t.spark, path, schema).select("year", "week", "revenue")


ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@check("""
SELECT o_custkey AS customer, min(o_orderkey) AS first_order FROM orders
WHERE o_totalprice IS NOT NULL GROUP BY 1
""")
def stream_ingest(t: Tables) -> DataFrame:
    """The order file, or folder of files, as a stream into a keyed table: a customer's first order stays.

    A second run over the same folder finds no new file.
    """
    schema = T.StructType([T.StructField("customer", T.LongType()), T.StructField("first_order", T.LongType())])
    path, checkpoint = _run_folder(t, "stream"), _run_folder(t, "progress")

    def shape(batch: DataFrame) -> DataFrame:
        kept = batch.where(F.col("o_totalprice").isNotNull())
        return kept.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("first_order"))

    for _ in range(2):
        source = parquet_stream(t.spark, f"{t.folder}/orders.parquet*", ORDERS_SCHEMA, "*.parquet")
        ingest_new_files(
            t.spark, source, shape, path, schema, ["customer"], [F.col("first_order")], checkpoint
        ).awaitTermination()
    return read_table(t.spark, path, schema)
