import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.checks.ingest import order_documents
from turnstile.checks.registry import Tables
from turnstile.constants import ANSWER_HEADINGS, RECEIPT_HEADINGS
from turnstile.functions.keys import content_key, order_line_key
from turnstile.operators.quality import ingest_summary, key_uniqueness, summary_totals
from turnstile.plans.budgets import monthly_budget_rows, prepared_budgets, weekly_budget_rows
from turnstile.plans.offline import offline_sales
from turnstile.plans.orders import order_lines, rows_of_order, unreadable_amounts
from turnstile.sources.landed import (
    active_cities,
    parse_order_documents,
    read_answers,
    read_budget_sheets,
    read_order_documents,
    read_receipts,
    whole_files_only,
)

LOADED = datetime(2025, 11, 6, 12, 30)


def write_csv(path, heading, rows):
    lines = [",".join(heading)] + [",".join(f'"{v}"' if "," in v else v for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def receipts_folder(tmp_path):
    def row(time, till, item, amount):
        return [time, till, "q1", "Чек 1", "Билеты", item, "Вход", "2", amount]

    write_csv(tmp_path / "a.csv", RECEIPT_HEADINGS, [
        row("13.10.2025 14:21:58", "ККТ с передачей в ОФД (Омск)", "001", "500.00"),
        row("13.10.2025 14:21:58", "Другая касса", "002", "250.50"),
        row("14.10.2025 09:00:00", "ККМ (Ростов)", "003", ""),
    ])
    write_csv(tmp_path / "bad.csv", RECEIPT_HEADINGS, [
        row("13.10.2025 10:00:00", "ККМ (Ростов)", "004", "1.00"),
        row("2025-10-13 10:00:00", "ККМ (Ростов)", "005", "1.00"),
    ])
    write_csv(tmp_path / "words.csv", RECEIPT_HEADINGS, [row("13.10.2025 10:00:00", "ККМ (Ростов)", "007", "много")])
    write_csv(tmp_path / "notes.txt", RECEIPT_HEADINGS, [row("13.10.2025 10:00:00", "x", "006", "9.00")])
    return str(tmp_path)


def test_receipts(spark, receipts_folder):
    got = read_receipts(spark, receipts_folder, LOADED).rows
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.RECEIPTS]
    rows = {r["itenm_id"]: r for r in got.collect()}
    assert set(rows) == {"001", "002"}, "no amount, bad file and other file types are left out"
    first = rows["001"]
    assert (first["sale_date"], first["amount"], first["load_dttm"]) == (
        datetime(2025, 10, 13, 14, 21, 58), Decimal("500.00"), LOADED,
    )
    key = spark.range(1).select(
        content_key(F.lit("2025-10-13 14:21:58ККТ с передачей в ОФД (Омск)Чек 1001"))
    ).first()[0]
    assert first["hash_256"] == key


def test_good_rows_are_not_shuffled_to_drop_bad_files(spark, receipts_folder):
    plan = read_receipts(spark, receipts_folder, LOADED).rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_receipts_row_quarantine(spark, receipts_folder):
    got = read_receipts(spark, receipts_folder, LOADED, whole_files=False).rows
    assert sorted(r["itenm_id"] for r in got.collect()) == ["001", "002", "004"]


def test_offline_sales_of_a_day(spark, receipts_folder):
    receipts = read_receipts(spark, receipts_folder, LOADED).rows
    sales = offline_sales(receipts, date(2025, 10, 13))
    assert {(r["item"], r["city"], r["revenue"]) for r in sales.collect()} == {
        ("Вход", "Omsk", Decimal("500.00")), ("Вход", None, Decimal("250.50")),
    }
    assert sales.columns == schemas.OFFLINE_SALES.names
    assert offline_sales(receipts, date(2025, 10, 14)).count() == 0


def test_answers(spark, tmp_path):
    write_csv(tmp_path / "omsk.csv", ANSWER_HEADINGS, [
        ["05.11.2025 10:00:00", "Смс", "2", "Омск"], ["", "Смс", "1", "Омск"],
    ])
    got = read_answers(spark, str(tmp_path), LOADED).rows.collect()
    assert [(r["date"], r["value"], r["qty"], r["city"], r["file_name"]) for r in got] == [
        (datetime(2025, 11, 5, 10), "Смс", 2, "Омск", "omsk.csv")
    ]


def test_budget_sheets(spark, tmp_path, rows_of):
    week = ["Канал", "Неделя", "Дата с", "Дата по", "Омск", "Москва", "Другой"]
    write_csv(tmp_path / "w1.csv", week, [
        ["2gis", "41", "06.10.2025", "12.10.2025", "1 000,50", "", "abc"],
        ["другой", "42", "13.10.2025", "19.10.2025", "12,5", "16,359.43", "7"],
    ])
    write_csv(tmp_path / "w2.csv", week[1:4] + ["Уфа"], [["41", "2025-10-06", "2025-10-12", "5"]])
    write_csv(tmp_path / "bad.csv", ["x"], [["1"]])
    sheets = {k: str(tmp_path / f"{k}.csv") for k in ("w1", "w2", "bad", "missing")}
    good, bad = read_budget_sheets(spark, sheets, "Дата с")
    assert bad == ["bad", "missing"]
    rows = weekly_budget_rows(good[0]).unionByName(weekly_budget_rows(good[1]))
    assert rows.columns == schemas.BUDGETS_WEEK.names
    assert rows_of(rows, "channel", "dateFrom", "city", "budget") == [
        ("2gis", "06.10.2025", "Omsk", 1000.5),
        ("2gis", "13.10.2025", "Moscow", 16359.43),
        ("2gis", "13.10.2025", "Omsk", 125.0),
        ("2gis", "13.10.2025", "Другой", 7.0),
        ("Channel_w2", "2025-10-06", "Ufa", 5.0),
    ]
    dates = spark.sql("SELECT date'2025-10-06' AS date, 2025L AS year, 41L AS week, 'w' AS week_range")
    cube = prepared_budgets(rows, dates)
    assert rows_of(cube, "date_from", "city", "channel", "current_week", "aggregation_level") == sorted([
        (date(2025, 10, 6), "Omsk", "Карты 2gis", Decimal("1000.500000"), "Детальные данные"),
        (date(2025, 10, 6), "Omsk", "Итого", Decimal("1000.500000"), "Итого по городу"),
        (date(2025, 10, 6), "Итого", "Карты 2gis", Decimal("1000.500000"), "Итого по каналу"),
        (date(2025, 10, 6), "Итого", "Итого", Decimal("1000.500000"), "Общий итог"),
    ], key=lambda t: [(v is not None, str(v)) for v in t])


def test_two_sheet_columns_of_one_city_are_reported(spark):
    sheet = spark.createDataFrame(
        [("2gis", "06.10.2025", "12.10.2025", "41", "1", "2", "2gis")],
        "`Канал` string, `Дата с` string, `Дата по` string, `Неделя` string, `Москва` string, `Яхрома` string, channel string",
    )
    report = key_uniqueness(weekly_budget_rows(sheet), "id").first()
    assert tuple(report) == (2, 1, 1, False)


def test_monthly_sheet(spark, rows_of):
    sheet = spark.createDataFrame(
        [("2gis", "15.10.2025", "5", "2gis"), ("2gis", "2025-11-01", "6", "2gis"), ("2gis", "10.2025", "7", "2gis")],
        "`Канал` string, month string, `Омск` string, channel string",
    )
    assert rows_of(monthly_budget_rows(sheet), "date", "city", "budget") == [
        ("2025-10-01", "Omsk", 5.0), ("2025-11-01", "Omsk", 6.0),
    ]


ORDERS = [
    {
        "id": 1, "eventSessionId": 10, "created_at": "2025-10-13T14:21:58+0300",
        "status": {"name": "paid", "title": "Оплачен"}, "payment": {"amount": 1000, "discount": "5.5"},
        "tickets": [
            {"id": i, "price_nominal": "333.33", "ticket_type": {"id": 7, "name": "Вход", "price": 400}} for i in (1, 2, 3)
        ],
    },
    {"id": 2, "created_at": "2025-10-13T15:00:00", "status": {"name": "paid"}, "payment": {"amount": 1000}, "tickets": []},
    {"id": 3, "created_at": "2025-10-13T15:00:00"},
    {"id": 4, "created_at": "2025-10-13T15:00:00Z", "tickets": [{"id": 9}]},
    {"id": 5, "status": {"name": "paid"}},
]


@pytest.fixture
def documents(spark, tmp_path):
    folder = tmp_path / "event_id=77"
    folder.mkdir()
    (folder / "page1.json").write_text("\n".join(json.dumps(o, ensure_ascii=False) for o in ORDERS), encoding="utf-8")
    return read_order_documents(spark, str(tmp_path))


def test_order_lines(documents):
    lines = order_lines(documents)
    assert lines.columns == schemas.ONLINE_SALES.names
    by_order = {}
    for r in lines.collect():
        by_order.setdefault(r["order_id"], []).append(r)
    assert {k: len(v) for k, v in by_order.items()} == {"1": 3, "2": 1, "3": 1}
    ticket, bare, empty = by_order["1"][0], by_order["2"][0], by_order["3"][0]
    assert (ticket["event_id"], ticket["created_at"]) == ("77", datetime(2025, 10, 13, 14, 21, 58))
    assert (ticket["timepad_commission"], ticket["acquiring_commission"]) == (Decimal("8.33"), Decimal("7.33"))
    assert (ticket["payment_discount"], ticket["ticket_price"]) == (Decimal("5.50"), Decimal("400.00"))
    assert (bare["timepad_commission"], bare["ticket_id"], bare["price_nominal"]) == (Decimal("25.00"), "", Decimal("0.00"))
    assert (empty["status_name"], empty["event_session_id"], empty["timepad_commission"]) == ("", "", Decimal("0.00"))
    assert len({r["order_hash"] for rows in by_order.values() for r in rows}) == 5


def test_unreadable_amounts(spark):
    docs = [
        {"id": 1, "payment": {"amount": "10"}}, {"id": 2, "payment": {"amount": "ten"}}, {"id": 3},
        {"id": 4, "tickets": [{"price_nominal": "1"}, {"price_nominal": "?"}]},
        {"id": 5, "tickets": [{"ticket_type": {"price": "-"}}]}, {"id": 6, "tickets": []},
    ]
    texts = spark.createDataFrame([(json.dumps(d), str(d["id"] % 2)) for d in docs], "doc string, event string")
    parsed = parse_order_documents(texts, "doc", "event")
    assert {r["id"] for r in parsed.where(unreadable_amounts()).collect()} == {"2", "4", "5"}
    assert whole_files_only(parsed, F.col("id") == "2", "event_id").count() == 3


def test_json_text_gives_the_same_lines(spark, documents, rows_of):
    texts = spark.createDataFrame([(json.dumps(o), "77") for o in ORDERS], "doc string, event string")
    columns = [c for c in schemas.ONLINE_SALES.names if c != "status_title"]
    got = order_lines(parse_order_documents(texts, "doc", "event"))
    assert rows_of(got, *columns) == rows_of(order_lines(documents), *columns)


def test_ingest_summary(spark, documents, rows_of):
    cities = spark.createDataFrame(
        [("77", "Omsk", True), ("78", "Ufa", True), ("79", "Kazan", False)], "event_id string, name_en string, is_active boolean"
    )
    docs = documents.withColumn("event_id", F.col("event_id").cast("string"))
    summary = ingest_summary(active_cities(cities), "event_id", docs, "event_id", rows_of_order())
    assert rows_of(summary, "event_id", "city", "orders_count", "tickets_count", "status") == [
        ("77", "Omsk", 5, 5, "success"), ("78", "Ufa", 0, 0, "error"),
    ]
    assert tuple(summary_totals(summary).first()) == (1, 1, 5)


def test_columns_are_read_by_name(spark, tmp_path):
    cells = dict(zip(RECEIPT_HEADINGS, ["13.10.2025 14:21:58", "ККМ (Ростов)", "q1", "Чек 1", "Билеты", "001", "Вход, взрослый", "2", "1000.00"], strict=True))
    turned = [*reversed(list(RECEIPT_HEADINGS)), "Ещё"]
    write_csv(tmp_path / "a.csv", RECEIPT_HEADINGS, [list(cells.values())])
    write_csv(tmp_path / "b.csv", turned, [[*reversed(list(cells.values())), "x"]])
    write_csv(tmp_path / "c.csv", [*list(RECEIPT_HEADINGS)[:-1], "Другое"], [list(cells.values())])
    write_csv(tmp_path / "d.csv", [*RECEIPT_HEADINGS, list(RECEIPT_HEADINGS)[0]], [[*cells.values(), "x"]])
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    rows, rejects = read_receipts(spark, str(tmp_path), LOADED)
    got = [(r["qty"], r["amount"], r["item"]) for r in rows.collect()]
    assert got == [(Decimal("2.000"), Decimal("1000.00"), "Вход, взрослый")] * 2
    assert sorted((r["file_path"][-5:], r["reason"]) for r in rejects.collect()) == [("c.csv", f"no column {list(RECEIPT_HEADINGS)[-1]}"), ("d.csv", "a column twice")]


def test_broken_lines_are_rejected(spark, tmp_path):
    good = ["13.10.2025 14:21:58", "ККМ (Ростов)", "q1", "Чек 1", "Билеты", "001", "Вход", "2", "1000.00"]
    write_csv(tmp_path / "a.csv", RECEIPT_HEADINGS, [good, good[:5], [*good, "x"], ["1.1.1", *good[1:]], [*good[:7], "two", "1"]])
    write_csv(tmp_path / "b.csv", RECEIPT_HEADINGS, [good])
    rows, rejects = read_receipts(spark, str(tmp_path), LOADED)
    assert rows.count() == 1
    assert sorted(r["reason"] for r in rejects.collect()) == ["not as many cells as the heading"] * 2 + ["unreadable number", "unreadable time"]
    assert read_receipts(spark, str(tmp_path), LOADED, whole_files=False).rows.count() == 2


def test_order_lines_make_an_orders_time_and_text_once(spark, documents):
    lines = order_lines(documents)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1, "the time is read once, not in the filter too"
    top = next(line for line in plan.splitlines() if "sha2(" in line)
    assert "created_at" not in top[: top.index("AS order_hash")], "the text an order's lines share is made before they are unfolded"
    assert lines.count() > 0 and lines.where(order_line_key() != F.col("order_hash")).count() == 0


def test_order_documents_make_a_lines_texts_once(spark, tmp_path):
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    day = datetime(1995, 3, 4, 5, 6, 7)
    rows = [(1, 2, 3, 2, 4.0, 10.5, 0.0, "R", "O", day), (1, None, 8, 1, None, None, 0.08, "A", 'a"b', None), (5, 6, 7, 3, 1.0, 2.0, 0.0, "N", None, day)]
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = order_documents(Tables(spark, str(tmp_path)))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as decimal(18,2))") == 1 and plan.count("cast(l_shipdate") == 1
    texts = {r["event"]: json.loads(r["document"]) for r in made.collect()}
    assert texts[7] == {"id": "5-6-7", "eventSessionId": "3", "created_at": "1995-03-04T05:06:07", "status": {"name": "cancelled"}, "payment": {"amount": "2.00"}}
    assert texts[8]["tickets"] == [{"id": "1", "ticket_type": {"name": "type 1"}}] and texts[8]["id"] == "1-8"
    assert [t["price_nominal"] for t in texts[3]["tickets"]] == ["11.50", "12.50"]
