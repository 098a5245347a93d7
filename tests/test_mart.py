from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from turnstile.constants import MART_CHANNELS, TOTAL
from turnstile.operators.quality import values_outside
from turnstile.plans.report import last_week, report_lines, report_rows
from turnstile.plans.revenue import revenue_by_source, week_over_week, weekly_receipt_revenue, weekly_revenue
from turnstile.plans.weekly import MART_COLUMNS, weekly_mart

CHANNELS = ("Смс", "Листовки", TOTAL)


@pytest.fixture
def mart(spark):
    cities = spark.createDataFrame([("Омск", "Omsk"), ("Уфа", "Ufa")], "name_ru string, name_en string")
    sales = spark.createDataFrame(
        [(2025, 41, "Omsk", "Смс", 4, 3), (2025, 42, "Omsk", "Смс", 1, 1), (2025, 42, "Omsk", TOTAL, 6, 4),
         (2025, 43, "Ufa", "Смс", 1, 1), (2025, 44, "Ufa", "Смс", 1, 1)],
        "year bigint, week bigint, city string, value_group string, total_tickets bigint, total_ads_qty bigint",
    )
    budgets = spark.createDataFrame(
        [(2025, 41, "Omsk", "Смс", D(150)), (2025, 41, "Омск", "Смс", D(50)), (2025, 42, "Омск", "Смс", D(100)),
         (2025, 42, "Omsk", "Вне списка", D(999))],
        "year bigint, week bigint, city string, channel string, current_week decimal(24,6)",
    )
    revenue = spark.createDataFrame(
        [(2025, 41, "Omsk", D(1000), D(10), 100.0), (2025, 42, "Omsk", D(600), D(5), 120.0), (2025, 42, "Ufa", D(70), D(0), 0.0)],
        "year bigint, week bigint, city string, total_amount decimal(18,2), offline_tickets decimal(18,3), sr_amount double",
    )

    def build(as_of):
        return weekly_mart(sales, budgets, revenue, cities, as_of, CHANNELS)

    return build


def test_worked_example(mart):
    rows = {(r["week"], r["ranked_city"], r["ranked_channel"]): r for r in mart(date(2025, 10, 23)).collect()}
    assert len(rows) == 3 * 3 * 3, "weeks up to the current one, two cities and the total, three channels"
    first, second = rows[41, "a_1. Омск", "a_1. Смс"], rows[42, "a_1. Омск", "a_1. Смс"]
    # Two spellings of the city carry one budget together.
    assert (first["channel_revenue"], first["channel_budget"], first["roas"], first["roas_2"]) == (400.0, D(200), 2.0, 2.0)
    assert (second["channel_revenue"], second["roas"]) == (120.0, pytest.approx(1.2))
    assert second["roas_2"] == pytest.approx(16 / 9) and second["roas_4"] == second["roas_2"]
    assert (second["channel_tickets_week_1"], second["city_revenue_week_1"], second["channel_answers_week_1"]) == (4, D(1000), 3)
    assert (second["city_answers"], second["city_budget"]) == (4, D(100))
    total = rows[42, "a_1. Омск", f"a_0. {TOTAL}"]
    assert (total["channel_tickets"], total["channel_budget"], total["roas"]) == (5, D(100), 6.0)
    ufa = rows[42, "b_2. Уфа", "a_1. Листовки"]
    assert (ufa["city_revenue"], ufa["channel_revenue"], ufa["roas"], ufa["city_average_check"]) == (D(70), 0.0, 0.0, 0.0)
    none = rows[43, "a_1. Омск", "a_1. Смс"]
    assert (none["channel_revenue"], none["city_tickets"], none["roas_2"]) == (None, 0, pytest.approx(1 / 5 * 600 / 100))


def test_order_and_columns(mart):
    df = mart(date(2025, 10, 23))
    assert df.columns == MART_COLUMNS and len(MART_COLUMNS) == 33
    keys = [(-r["week"], r["ranked_city"], r["ranked_channel"]) for r in df.collect()]
    assert keys == sorted(keys)


def test_ranks_need_the_last_full_week(mart):
    rows = mart(date(2025, 12, 20)).collect()
    assert len(rows) == 4 * 9 and all(r["ranked_city"] is None for r in rows)


def test_year_end_falls_into_week_one(mart):
    assert mart(date(2025, 12, 31)).count() == 0, "calendar year with ISO week: (2025, 1) comes before all"


def test_channels_the_mart_drops(spark):
    df = spark.createDataFrame([("Смс", 1), ("Телеграм (мессенджер)", 2), (None, 4)], "channel string, n int")
    got = {r["channel"]: r["total"] for r in values_outside(df, "channel", MART_CHANNELS, "n").collect()}
    assert got == {"Телеграм (мессенджер)": 2, None: 4}
    assert len(MART_CHANNELS) == 31


@pytest.fixture
def facts(spark):
    t = lambda d: datetime(2025, 10, d, 12)
    online = spark.createDataFrame(
        [("1", t(6), "paid", "Вход", D("100.00"), D("2.50"), D("2.20")), ("1", t(13), "paid", "Платформа", D("50.00"), D("0"), D("0")),
         ("2", t(13), "transfer_payment", "Вход", D("10.00"), D("0"), D("0")), ("9", t(13), "paid", "Вход", D("7.00"), D("0"), D("0")),
         ("1", t(13), "cancelled", "Вход", D("999.00"), D("0"), D("0"))],
        "event_id string, created_at timestamp_ntz, status_name string, ticket_type_name string, price_nominal decimal(18,2),"
        " timepad_commission decimal(18,2), acquiring_commission decimal(18,2)",
    )
    offline = spark.createDataFrame(
        [(t(6), "Билеты", 2, D("300.00"), "Omsk"), (t(13), "Кафе", 5, D("40.00"), "Omsk"), (t(13), "Билеты", 1, D("60.00"), None)],
        "sale_ts timestamp_ntz, item_category string, qty bigint, revenue decimal(18,2), city string",
    )
    cities = spark.createDataFrame(
        [("Омск", "Omsk", "1", "t1"), ("Москва", "Moscow", "2", "t2"), ("Яхрома", "Moscow", "2", "t2")],
        "name_ru string, name_en string, event_id string, kkm_name string",
    )
    return online, offline, cities


def test_weekly_revenue(facts, rows_of):
    got = {(r["week"], r["city"]): r for r in weekly_revenue(*facts).collect()}
    assert got[41, "Omsk"]["total_amount"] == D("395.30")
    assert (got[41, "Omsk"]["total_tickets"], got[41, "Omsk"]["sr_amount"]) == (3, 395.3 / 2)
    assert (got[42, "Omsk"]["total_amount"], got[42, "Omsk"]["total_tickets"], got[42, "Omsk"]["sr_amount"]) == (D("90.00"), 0, 0.0)
    assert got[42, "Moscow"]["total_amount"] == D("20.00"), "an event of two cities counts twice"
    assert got[42, None]["total_amount"] == D("60.00"), "an unknown till keeps its own row"
    assert got[42, TOTAL]["total_amount"] == D("50") + D("20") + D("40") + D("60")


def test_receipt_total_takes_every_receipt(spark, facts):
    online, _, cities = facts
    receipts = spark.createDataFrame(
        [(datetime(2025, 10, 6), "t1", "Билеты", 1, D("5.00")), (datetime(2025, 10, 6), "t9", "Билеты", 1, D("6.00"))],
        "sale_date timestamp_ntz, kkm string, item_category string, qty bigint, amount decimal(18,2)",
    )
    got = {(r["week"], r["city"]): r["total_amount"] for r in weekly_receipt_revenue(online, receipts, cities).collect()}
    assert got[41, "Omsk"] == D("100.30") and got[41, TOTAL] == D("106.30")


def test_changes_and_report(spark, facts):
    online, offline, cities = facts
    dates = spark.sql(
        "SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(weekofyear(date) AS BIGINT) AS week, concat('W', weekofyear(date)) AS week_range"
        " FROM (SELECT explode(sequence(date'2025-10-01', date'2025-10-31')) AS date)"
    )
    changes = week_over_week(revenue_by_source(online, offline, cities, dates))
    got = {(r["week"], r["city"], r["source"]): (r["amount"], r["change_percent"]) for r in changes.collect()}
    assert got[41, "Omsk", "all"] == (D("395.30"), None)
    assert got[42, "Omsk", "all"][1] == pytest.approx((90 - 395.3) / 395.3 * 100)
    assert got[42, "По всем городам", "online"][0] == D("67.00"), "the total takes unlisted events too"
    rows = report_rows(last_week(changes, 2025, 42))
    lines = [r["text"] for r in report_lines(rows.where(F.col("sklad").isNotNull())).collect()]
    assert lines == [
        "Отчет по продажам за W42", "",
        "По всем городам:", "🔴 all: 167 (-58%)", "🔴 on: 67 (-30%)", "🔴 off: 100 (-67%)", "",
        "Moscow", " all: 20 (—)", " on: 20 (—)", " off: 0 (—)", "",
        "Omsk", "🔴 all: 90 (-77%)", "🔴 on: 50 (-48%)", "🔴 off: 40 (-87%)", "",
    ]


def test_report_leaves_out_cities_without_all(spark):
    week = spark.createDataFrame(
        [("w", "Б", "online", 5.0, 1.0), ("w", "а", "all", 2.5, 10.5), ("w", "В", "all", 1234567.0, -0.4)],
        "week_range string, sklad string, source string, amount double, change_percent double",
    )
    rows = report_rows(week)
    assert {r["sklad"]: (r["all_amount"], r["all_change"]) for r in rows.collect()} == {"а": (2, 10), "В": (1234567, 0)}
    lines = [r["text"] for r in report_lines(rows).collect()]
    assert lines[2:4] == ["а", "🟢 all: 2 (+10%)"] and lines[7:9] == ["В", " all: 1 234 567 (0%)"]
