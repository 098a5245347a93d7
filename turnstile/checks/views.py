"""The test tables in the shape of the business tables.

Orders are the online sales, order lines the receipts, events the answers.  The
same mapping exists twice: as DataFrames here and as SQL in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.checks.registry import Tables
from turnstile.functions.labels import decode
from turnstile.functions.numbers import acquiring_fee, service_fee
from turnstile.schemas import MONEY

CHECK_REVENUE = ("F", "O")
CHECK_FEES = ("F", "P")
CHECK_TOKEN = "LOW"
CHECK_CATEGORY = "O"
TILLS = {str(i): f"NATION_{i}" for i in range(1, 7)}
ANSWER_CITY = {"P": "nation_1", "F": "nation_2", "O": "nation_3"}
BUDGET_CITY = {"P": "NATION_1", "F": "nation_2", "O": "NATION_4"}
ANSWER_VALUE = {
    "1-URGENT": "Карты 2gis",
    "2-HIGH": "Инстаграм (соц.сеть)",
    "3-MEDIUM": "Вконтакте (соц.сеть)",
    "4-NOT SPECIFIED": "Смс",
}
SHEET_CHANNELS = {
    "1-URGENT": "2gis",
    "2-HIGH": "Инстаграм Посевы",
    "3-MEDIUM": "ВК ADS",
    "4-NOT SPECIFIED": "Телеграм ADS",
    "5-LOW": "Радио",
}


def money(column: str):
    return F.col(column).cast(MONEY)


def cities(t: Tables) -> DataFrame:
    """One row per customer (its event) with two spellings of its nation; Asia is closed."""
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.select(
        F.lower("n_name").alias("name_ru"),
        F.col("n_name").alias("name_en"),
        F.col("c_custkey").alias("event_id"),
        F.col("c_custkey").cast("string").alias("kkm_name"),
        (F.col("r_name") != "ASIA").alias("is_active"),
    )


def open_cities(t: Tables) -> DataFrame:
    return cities(t).where("is_active")


def city_names(t: Tables) -> DataFrame:
    """One row per nation with both spellings."""
    return t.nation.select(F.lower("n_name").alias("name_ru"), F.col("n_name").alias("name_en"))


def online(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("event_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status_name"),
        F.col("o_orderpriority").alias("ticket_type_name"),
        money("o_totalprice").alias("price_nominal"),
        service_fee(money("o_totalprice"), "o_orderstatus", CHECK_FEES).alias("timepad_commission"),
        acquiring_fee(money("o_totalprice"), "o_orderstatus", CHECK_FEES).alias("acquiring_commission"),
    )


def offline(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_shipdate").alias("sale_ts"),
        F.col("l_linestatus").alias("item_category"),
        F.col("l_quantity").cast("long").alias("qty"),
        money("l_extendedprice").alias("revenue"),
        decode(F.col("l_linenumber").cast("string"), TILLS).alias("city"),
    )


def answers(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderdate").alias("date"),
        decode("o_orderpriority", ANSWER_VALUE).alias("value"),
        (F.length("o_orderpriority") - 4).cast("long").alias("qty"),
        decode("o_orderstatus", ANSWER_CITY).alias("city"),
    )


def budgets(t: Tables) -> DataFrame:
    return t.orders.select(
        decode("o_orderpriority", SHEET_CHANNELS).alias("channel"),
        F.col("o_orderdate").cast("string").alias("dateFrom"),
        decode("o_orderstatus", BUDGET_CITY).alias("city"),
        money("o_totalprice").alias("budget"),
    )


def dates(t: Tables) -> DataFrame:
    """A calendar from the first to the last order day."""
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))
    days = ends.select(F.explode(F.sequence("a", "z")).alias("date"))
    year, week = F.year("date").cast("long"), F.weekofyear("date").cast("long")
    label = F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))
    return days.select("date", year.alias("year"), week.alias("week"), label.alias("week_range"))


def _case(column: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


SQL = {
    "cities": """
        SELECT lower(n_name) AS name_ru, n_name AS name_en, c_custkey AS event_id,
               CAST(c_custkey AS VARCHAR) AS kkm_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""",
    "city_names": "SELECT lower(n_name) AS name_ru, n_name AS name_en FROM nation",
    "online": """
        SELECT o_custkey AS event_id, o_orderdate AS created_at, o_orderstatus AS status_name,
               o_orderpriority AS ticket_type_name, CAST(o_totalprice AS DECIMAL(18,2)) AS price_nominal,
               CASE WHEN o_orderstatus IN ('F','P')
                    THEN round(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.025 AS DECIMAL(4,3)), 2)
                    ELSE 0 END AS fee1,
               CASE WHEN o_orderstatus IN ('F','P')
                    THEN round(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.022 AS DECIMAL(4,3)), 2)
                    ELSE 0 END AS fee2
        FROM orders""",
    "offline": f"""
        SELECT l_shipdate AS sale_ts, l_linestatus AS item_category,
               CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue,
               {_case("CAST(l_linenumber AS VARCHAR)", TILLS)} AS city
        FROM lineitem""",
    "answers": f"""
        SELECT o_orderdate AS date, {_case("o_orderpriority", ANSWER_VALUE)} AS value,
               length(o_orderpriority) - 4 AS qty, {_case("o_orderstatus", ANSWER_CITY)} AS city
        FROM orders""",
    "budgets": f"""
        SELECT {_case("o_orderpriority", SHEET_CHANNELS)} AS channel,
               CAST(o_orderdate AS DATE) AS date_from, {_case("o_orderstatus", BUDGET_CITY)} AS city,
               CAST(o_totalprice AS DECIMAL(18,2)) AS budget
        FROM orders""",
    "dates": """
        SELECT CAST(d AS DATE) AS date, CAST(extract(year FROM d) AS BIGINT) AS year,
               CAST(extract(week FROM d) AS BIGINT) AS week,
               CAST(extract(year FROM d) AS VARCHAR) || '-W'
                 || lpad(CAST(extract(week FROM d) AS VARCHAR), 2, '0') AS week_range
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
              FROM orders)""",
}


def ctes(*names: str) -> str:
    """``WITH`` clause of the named business tables, open for more."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names)
