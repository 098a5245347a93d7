"""The whole way from landing folders to the report, run twice."""

import glob
import json
import os
from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from turnstile import jobs, schemas
from turnstile.constants import ANSWER_HEADINGS, RECEIPT_HEADINGS
from turnstile.session import shared_folder
from turnstile.sources.tables import replace_table

LOADED = datetime(2025, 10, 20, 6)


def csv(path, heading, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(heading), *rows]) + "\n", encoding="utf-8")


def receipt(time, item, category, qty, amount, till="ККТ с передачей в ОФД (Омск)"):
    return f"{time},{till},q,Чек {item},{category},{item},Вход,{qty},{amount}"


def land(root):
    csv(
        root / "receipts" / "a.csv", RECEIPT_HEADINGS,
        receipt("06.10.2025 14:21:58", 1, "Билеты", 4, "1000.00"), receipt("13.10.2025 14:30:00", 2, "Билеты", 1, "100.00"),
        receipt("13.10.2025 15:00:00", 3, "Билеты", 4, "500.00"), receipt("13.10.2025 16:00:00", 4, "Кафе", 1, "20.00", "Чужая"),
    )
    csv(root / "cancelled" / "a.csv", RECEIPT_HEADINGS, receipt("06.10.2025 14:21:58", 9, "Билеты", 1, "5.00"))
    csv(root / "answers" / "a.csv", ANSWER_HEADINGS, "06.10.2025 14:22:00,Листовки,1,Омск", "13.10.2025 14:30:08,Листовки,1,Омск")
    csv(root / "sheets" / "s.csv", ["Канал", "Неделя", "Дата с", "Дата по", "Омск"], "2gis,41,06.10.2025,12.10.2025,200", "2gis,42,13.10.2025,19.10.2025,100")
    csv(root / "sheets" / "m.csv", ["Канал", "Год", "month", "Месяц", "Омск"], "2gis,2025,15.10.2025,10,300")
    order = {
        "id": 1, "eventSessionId": 2, "created_at": "2025-10-13T10:00:00+0300", "status": {"name": "paid", "title": "т"},
        "payment": {"amount": 100}, "tickets": [{"id": 5, "price_nominal": 100, "ticket_type": {"id": 1, "name": "Вход", "price": 100}}],
    }
    folder = root / "orders" / "event_id=77"
    folder.mkdir(parents=True)
    (folder / "p.json").write_text(json.dumps(order), encoding="utf-8")


def test_from_landing_to_report(spark, tmp_path, rows_of):
    land(tmp_path)
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    cities = spark.createDataFrame([("Омск", "Omsk", "77", "ККТ с передачей в ОФД (Омск)", True)], schemas.CITIES)
    replace_table(cities, w.path("cities"))
    dates = spark.sql("SELECT explode(sequence(date'2025-10-01', date'2025-10-31')) AS date").select(
        "date", F.lit(2025).cast("long").alias("year"), F.weekofyear("date").cast("long").alias("week"),
        F.concat(F.lit("W"), F.weekofyear("date")).alias("week_range"),
    )
    replace_table(dates, w.path("dates"))
    versions = spark.createDataFrame(
        [(datetime(2025, 10, 13, 14), "Омск", "Листовки", 3, LOADED)], schemas.ANSWER_VERSIONS
    )
    replace_table(versions, w.path("answer_versions"))

    counts = []
    for _ in range(2):
        jobs.load_receipts(w, str(tmp_path / "receipts"), LOADED)
        jobs.load_cancelled_receipts(w, str(tmp_path / "cancelled"), LOADED)
        jobs.load_answers(w, str(tmp_path / "answers"), LOADED)
        unique, bad = jobs.load_week_budgets(w, {"s": str(tmp_path / "sheets" / "s.csv"), "m": str(tmp_path / "sheets" / "m.csv")})
        jobs.load_month_budgets(w, {"m": str(tmp_path / "sheets" / "m.csv")})
        summary = jobs.load_orders(w, str(tmp_path / "orders"), LOADED)
        jobs.refresh_offline_sales(w)
        jobs.refresh_offline_sales(w, date(2025, 10, 13))
        jobs.refresh_sales(w)
        jobs.refresh_sales(w, "month")
        jobs.refresh_budgets(w)
        jobs.refresh_budgets(w, "month")
        jobs.refresh_daily_answers(w, date(2025, 10, 12))
        jobs.refresh_weekly_revenue(w)
        jobs.refresh_weekly_mart(w, date(2025, 10, 20))
        tables = (
            "receipts", "receipts_cancel", "answers", "budgets", "budgets_month", "online_sales", "offline_sales",
            "sales", "sales_month", "prepared_budgets", "prepared_budgets_month", "daily_answers", "weekly_revenue", "weekly_mart",
        )
        counts.append({t: w.read(t).count() for t in tables})
    assert counts[0] == counts[1]
    for _ in range(2):
        jobs.load_new_receipts(w, str(tmp_path / "receipts"), LOADED, "followed").awaitTermination()
    key = ["hash_256", "sale_date", "amount", "sale_day"]
    assert rows_of(w.read("followed"), *key) == rows_of(w.read("receipts"), *key)
    assert rows_of(jobs.tills_without_city(w)) == [("Чужая", 1, D("20.00"))]
    assert jobs.channels_outside_mart(w).count() == 0
    assert counts[0]["receipts"] == 4 and counts[0]["receipts_cancel"] == 1 and counts[0]["weekly_mart"] == 2 * 2 * 31
    assert bad == ["m"] and tuple(unique.first()) == (2, 2, 0, True)
    assert rows_of(summary, "event_id", "orders_count", "tickets_count", "status") == [("77", 1, 1, "success")]
    sales = rows_of(w.read("sales").where("city = 'Omsk'"), "week", "value_group", "total_tickets", "total_ads_qty")
    assert sales == [
        (41, "Итого", D("4.000"), 1), (41, "Листовки", D("4.000"), 1), (42, "Без ответа", D("4.000"), None),
        (42, "Итого", D("5.000"), 1), (42, "Листовки", D("1.000"), 1),
    ]
    # The mart's budgets are those of channels it lists; all of them are in the total.
    mart = {(r["week"], r["ranked_city"], r["ranked_channel"]): r for r in w.read("weekly_mart").collect()}
    row = mart[42, "a_1. Омск", "a_1. Листовки"]
    assert (row["city_revenue"], row["city_tickets"], row["channel_tickets"]) == (D("695.30"), D("5.000"), D("1.000"))
    assert row["channel_revenue"] == 695.3 / 5 and row["city_budget"] == D("100.000000")
    assert w.read("prepared_budgets_month").where("city = 'Omsk' AND channel = 'Итого'").first()["current_month"] == D("300")
    lines = [r["text"] for r in jobs.weekly_report(w, date(2025, 10, 20)).where("text <> ''").collect()]
    assert lines[0] == "Отчет по продажам за W42"
    assert lines[1:5] == ["По всем городам:", "🔴 all: 715 (-28%)", " on: 95 (—)", "🔴 off: 620 (-38%)"]
    assert lines[5:] == ["Omsk", "🔴 all: 695 (-30%)", " on: 95 (—)", "🔴 off: 600 (-40%)"]


def order(status, number=1):
    return {
        "id": number, "eventSessionId": 2, "created_at": "2025-10-13T10:00:00+0300", "status": {"name": status, "title": "т"},
        "payment": {"amount": 100}, "tickets": [{"id": 5, "price_nominal": 100, "ticket_type": {"id": 1, "name": "Вход", "price": 100}}],
    }


def land_order(folder, name, when, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    os.utime(folder / name, (when, when))


def warehouse(spark, tmp_path, events=("77",)):
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    replace_table(spark.createDataFrame([("Омск", "Omsk", e, "т", True) for e in events], schemas.CITIES), w.path("cities"))
    return w


def handed_over(spark):
    return set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/*"))


def test_newest_order_wins_in_one_folder_and_in_separate_loads(spark, tmp_path):
    w, before = warehouse(spark, tmp_path), handed_over(spark)
    status = lambda: [r["status_name"] for r in w.read("online_sales").collect()]
    both = tmp_path / "both" / "event_id=77"
    land_order(both, "1.json", 1_760_000_000, json.dumps(order("paid")))
    jobs.load_orders(w, str(both.parent), LOADED)
    assert status() == ["paid"]
    land_order(both, "2.json", 1_760_000_100, json.dumps(order("cancelled")))
    jobs.load_orders(w, str(both.parent), LOADED)
    assert status() == ["cancelled"]
    late = tmp_path / "late" / "event_id=77"
    land_order(late, "1.json", 1_760_000_050, json.dumps(order("paid")))
    jobs.load_orders(w, str(late.parent), LOADED)
    assert status() == ["cancelled"], "an older file that comes late overwrites nothing"
    assert handed_over(spark) == before, "runs leave no folder"


def test_cut_document_makes_its_event_an_error(spark, tmp_path, rows_of):
    w = warehouse(spark, tmp_path, ("77", "78"))
    land_order(tmp_path / "o" / "event_id=77", "p.json", 1_760_000_000, json.dumps(order("paid")), json.dumps(order("paid", 2))[:50])
    land_order(tmp_path / "o" / "event_id=78", "p.json", 1_760_000_000, json.dumps(order("paid", 3)))
    for _ in range(2):
        summary = jobs.load_orders(w, str(tmp_path / "o"), LOADED)
    assert rows_of(summary, "event_id", "orders_count", "status") == [("77", 0, "error"), ("78", 1, "success")]
    assert [r["order_id"] for r in w.read("online_sales").collect()] == ["3"]
    reject = w.read("rejects").collect()
    assert [(r["file_path"].split("/")[-2], r["line"], r["reason"]) for r in reject] == [("event_id=77", json.dumps(order("paid", 2))[:50], "broken document")]


def test_files_are_told_apart_by_path_and_rejects_are_kept(spark, tmp_path, rows_of):
    w, before = warehouse(spark, tmp_path), handed_over(spark)
    land = tmp_path / "r"
    csv(land / "load=1" / "x.csv", RECEIPT_HEADINGS, receipt("06.10.2025 14:21:58", 1, "Билеты", 4, "1000.00"))
    csv(land / "load=2" / "x.csv", RECEIPT_HEADINGS, receipt("06.10.2025 14:21:58", 2, "Билеты", 4, "1.00"), "06.10.2025 14:21:58,half a line")
    csv(land / "load=3" / "x.csv", list(RECEIPT_HEADINGS)[:-1], "a,b,c,d,e,f,g,h")
    for _ in range(2):
        counts = jobs.load_receipts(w, str(land), LOADED)
    assert [(r["item"], r["amount"]) for r in w.read("receipts").select(F.col("receipt_name").alias("item"), "amount").collect()] == [("Чек 1", D("1000.00"))]
    assert sorted((r["file_path"].split("/")[-2], r["reason"][:9], r["line_count"]) for r in counts.collect()) == [("load=2", "not as ma", 1), ("load=3", "no column", 1)]
    assert w.read("rejects").count() == 2
    jobs.load_new_receipts(w, str(land), LOADED, "followed").awaitTermination()
    assert w.read("followed").count() == 1 and w.read("rejects").count() == 2
    csv(land / "load=2" / "y.csv", RECEIPT_HEADINGS, receipt("06.10.2025 14:21:58", 2, "Билеты", 4, "1.00"))
    jobs.load_new_receipts(w, str(land), LOADED, "followed").awaitTermination()
    assert w.read("followed").count() == 2, "a corrected file is taken under a new name"
    assert handed_over(spark) == before, "micro-batches leave no folder"


def test_refresh_by_periods_equals_full_refresh_across_a_year_end(spark, tmp_path, rows_of):
    w = warehouse(spark, tmp_path)
    times = [f"{d}.{m}.{y} 23:59:58" for d, m, y in [("28", "12", 2023), ("01", "01", 2024), ("15", "06", 2024), ("29", "12", 2024), ("30", "12", 2024), ("31", "12", 2024), ("01", "01", 2025), ("08", "01", 2025)]]
    csv(tmp_path / "r" / "a.csv", RECEIPT_HEADINGS, *[receipt(t, i, "Билеты", i + 1, f"{i + 1}00.00") for i, t in enumerate(times)])
    csv(tmp_path / "a" / "a.csv", ANSWER_HEADINGS, "31.12.2024 00:00:01,Листовки,1,Омск", "01.01.2025 00:00:02,Листовки,2,Омск")
    jobs.load_receipts(w, str(tmp_path / "r"), LOADED)
    jobs.load_answers(w, str(tmp_path / "a"), LOADED)
    jobs.refresh_offline_sales(w)
    read = lambda: [rows_of(w.read(t), "year", p, "city", *m) for t, p, m in (("sales", "week", ["value_group", "total_tickets", "total_ads_qty"]), ("sales_month", "month", ["value_group", "total_tickets"]), ("weekly_revenue", "week", ["total_amount"]))]
    for period in ("week", "month"):
        jobs.refresh_sales(w, period)
    jobs.refresh_weekly_revenue(w)
    full = read()
    assert {r[:2] for r in full[0]} >= {(2024, 1), (2025, 1), (2023, 52), (2024, 52)} and all(full)
    for table in ("sales", "sales_month", "weekly_revenue"):
        replace_table(w.read(table).limit(0), w.path(table))
    for days in ((date(2023, 12, 28), date(2024, 12, 30)), (date(2024, 12, 30), date(2025, 1, 31))):
        for period in ("week", "month"):
            jobs.refresh_sales(w, period, days)
        jobs.refresh_weekly_revenue(w, days)
    assert read() == full
    days = [date(2024, 1, 1), date(2024, 12, 30)]
    plan = jobs._on(jobs._offline(w), "sale_day", days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [sale_day#" in plan


def test_budgets_of_unreadable_dates_are_reported(spark, tmp_path, rows_of):
    w = warehouse(spark, tmp_path)
    rows = [("1", "2gis", "06.10.2025", "x", "Omsk", 5.0), ("2", "2gis", "soon", "x", "Omsk", 7.0), ("3", "2gis", "soon", "x", "Ufa", 1.0)]
    replace_table(spark.createDataFrame(rows, schemas.BUDGETS_WEEK), w.path("budgets"))
    assert rows_of(jobs.budgets_without_date(w)) == [("soon", 2, 8.0)]


def test_refresh_by_days_empties_periods_that_lost_all_rows(spark, tmp_path, rows_of):
    w = warehouse(spark, tmp_path)
    times = ["15.06.2024 12:00:00", "17.06.2024 12:00:00", "01.07.2024 10:00:00"]
    csv(tmp_path / "r" / "a.csv", RECEIPT_HEADINGS, *[receipt(t, i, "Билеты", i + 1, f"{i + 1}00.00") for i, t in enumerate(times)])
    jobs.load_receipts(w, str(tmp_path / "r"), LOADED)
    jobs.refresh_offline_sales(w)
    for period in ("week", "month"):
        jobs.refresh_sales(w, period)
    weeks = lambda: {(r["year"], r["week"]) for r in w.read("sales").collect()}
    months = lambda: {(r["year"], r["month"]) for r in w.read("sales_month").collect()}
    assert {(2024, 24), (2024, 25), (2024, 27)} <= weeks() and {(2024, 6), (2024, 7)} <= months()
    # All sales of June are cancelled: the offline table loses them, the refresh of those days empties their periods.
    kept = w.read("offline_sales").where("month(sale_day) <> 6")
    replace_table(hand_copy(kept, tmp_path), w.path("offline_sales"), ["sale_day"])
    for period in ("week", "month"):
        jobs.refresh_sales(w, period, (date(2024, 6, 15), date(2024, 6, 17)))
    assert not {(2024, 24), (2024, 25)} & weeks() and (2024, 27) in weeks()
    assert (2024, 6) not in months() and (2024, 7) in months()


def hand_copy(df, tmp_path):
    """The rows written aside first, so that the table they came from can be replaced."""
    path = str(tmp_path / "aside")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
