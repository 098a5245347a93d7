"""Rule tables: literal inputs with worked-out results."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from turnstile.operators.reshape import unpivot_numbers
from turnstile.constants import BUDGET_SHARES, FEE_STATUSES, RANK_LABELS
from turnstile.functions import keys, labels, numbers, times


@pytest.fixture
def apply(spark):
    def run(values, kind, build):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("v")).alias("r")).collect()]

    return run


def test_locale_number(apply):
    cases = {
        None: None, "": None, "16359,43": 16359.43, "16,359.43": 16359.43, "1 234,50": 1234.5,
        "1 234,50": 1234.5, "12,5": 125.0, "16,359": 16359.0, "1,234,50": None, "abc": None,
        "-12,50": -12.5, "  7 ": 7.0, "1e3": 1000.0, "5d": None, "1.2.3": None, ",50": 0.5,
    }
    assert apply(list(cases), "string", numbers.locale_number) == list(cases.values())


def test_order_timestamp(apply):
    at = datetime(2025, 10, 13, 14, 21, 58)
    cases = {
        "2025-10-13T14:21:58+0300": at, "2025-10-13T14:21:58": at, "2025-10-13T14:21:58+03:00": at,
        "2025-10-13T14:21:58Z": None, "2025-10-13T14:21:58-0300": None, "": None, None: None,
        "2025-10-13 14:21:58": None, "2025-13-13T14:21:58": None, "2025-10-13T14:21:58+2500": None,
    }
    assert apply(list(cases), "string", times.order_timestamp) == list(cases.values())


def test_till_timestamp_is_strict(apply):
    cases = {
        "13.10.2025 14:21:58": datetime(2025, 10, 13, 14, 21, 58), "3.1.2025 4:05:06": datetime(2025, 1, 3, 4, 5, 6),
        "2025-10-13 14:21:58": None, "13.10.2025": None, "31.02.2025 10:00:00": None, None: None,
    }
    assert apply(list(cases), "string", times.till_timestamp) == list(cases.values())


def test_day_first_timestamp(apply):
    cases = {
        "05.11.2025 10:00": datetime(2025, 11, 5, 10), "5/11/2025": datetime(2025, 11, 5),
        "2025-11-05 10:00:07": datetime(2025, 11, 5, 10, 0, 7), "11/25/2025": datetime(2025, 11, 25),
        "2025-11-05T10:00:07.25": datetime(2025, 11, 5, 10, 0, 7, 250000), "soon": None, None: None,
    }
    assert apply(list(cases), "string", times.day_first_timestamp) == list(cases.values())


def test_month_start_text(apply):
    cases = {"15.10.2025": "2025-10-01", "2025-10-01": "2025-10-01", "10.2025": None, "": "", None: None}
    assert apply(list(cases), "string", times.month_start_text) == list(cases.values())


def test_calendar_year_with_iso_week(apply):
    days = [date(2024, 12, 30), date(2027, 1, 1), date(2024, 1, 1)]
    both = lambda c: F.concat_ws("/", times.calendar_year(c), times.iso_week(c), times.iso_year(c))
    assert apply(days, "date", both) == ["2024/1/2025", "2027/53/2026", "2024/1/2024"]


def test_round_to_second(apply):
    cases = {
        datetime(2025, 10, 13, 14, 21, 58, 499999): datetime(2025, 10, 13, 14, 21, 58),
        datetime(2025, 10, 13, 14, 21, 58, 500000): datetime(2025, 10, 13, 14, 21, 59),
        datetime(2025, 12, 31, 23, 59, 59, 700000): datetime(2026, 1, 1),
        datetime(1999, 12, 31, 23, 59, 58, 500000): datetime(1999, 12, 31, 23, 59, 58),
        datetime(1999, 12, 31, 23, 59, 58, 500001): datetime(1999, 12, 31, 23, 59, 59),
    }
    assert apply(list(cases), "timestamp_ntz", times.round_to_second) == list(cases.values())


def test_epoch_second_rounds_down(apply):
    cases = {datetime(1970, 1, 1, 0, 0, 1, 900000): 1, datetime(1969, 12, 31, 23, 59, 59, 500000): -1}
    assert apply(list(cases), "timestamp_ntz", times.epoch_second) == list(cases.values())


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:07.6' AS t")
        got = gap.select(times.round_to_second("t"), times.epoch_second("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(got) == (datetime(2024, 3, 10, 2, 30, 8), 1710037807)


@pytest.mark.parametrize(
    ("amount", "status", "parts", "expected"),
    [
        ("1000", "paid", 3, ("8.33", "7.33")),
        ("1000", "paid", 0, ("25.00", "22.00")),
        ("1000", "transfer_payment", 3, ("0.00", "0.00")),
        ("0.20", "paid_ur", 1, ("0.01", "0.00")),
        ("1000", "paid_offline", 1, ("25.00", "22.00")),
    ],
)
def test_fees(spark, amount, status, parts, expected):
    df = spark.createDataFrame([(Decimal(amount), status, parts)], "a decimal(18,2), s string, n int")
    got = df.select(
        numbers.fee_share(numbers.service_fee("a", "s", FEE_STATUSES), "n"),
        numbers.fee_share(numbers.acquiring_fee("a", "s", FEE_STATUSES), "n"),
    ).first()
    assert tuple(got) == tuple(Decimal(x) for x in expected)


def test_budget_share(spark):
    rows = [("Инстаграм Посевы", Decimal("100.00")), ("2gis", Decimal("100.00")), (None, Decimal("7.00"))]
    df = spark.createDataFrame(rows, "c string, b decimal(18,2)")
    got = [r[0] for r in df.select(numbers.budget_share("b", "c", BUDGET_SHARES)).collect()]
    assert got == [Decimal("66.666667"), Decimal("100.000000"), Decimal("7.000000")]


def test_fractions(spark):
    df = spark.sql("SELECT 1 a, 4 b UNION ALL SELECT 1, 0 UNION ALL SELECT CAST(NULL AS INT), 4")
    safe = [r[0] for r in df.select(numbers.zero_safe_fraction("a", "b")).collect()]
    guarded = [r[0] for r in df.select(numbers.zero_guarded_fraction("a", "b")).collect()]
    assert safe == [0.25, 0.0, 0.0]
    assert guarded == [0.25, 0.0, None]


def test_report_formats(apply):
    assert apply([1234567, 0, -1200, 12], "bigint", numbers.spaced_number) == ["1 234 567", "0", "-1 200", "12"]
    assert apply([5, -3, 0, None], "bigint", numbers.signed_percent) == ["+5%", "-3%", "0%", "—"]
    assert apply([5, -3, 0, None], "bigint", numbers.trend_mark) == ["🟢", "🔴", "", ""]
    assert apply([0.5, 1.5, 2.5, -0.5, -1.5], "double", numbers.whole_half_even) == [0, 2, 2, 0, -2]


def test_keys(spark):
    row = spark.sql("SELECT timestamp_ntz'2025-10-13 14:21:58' t, 'ККМ' k, CAST(NULL AS STRING) n, 5 i")
    text, spaced = row.select(
        keys.joined_text("t", "k", "n", "i"), keys.joined_text("k", "n", "i", sep="_", null_token="нет")
    ).first()
    assert text == "2025-10-13 14:21:58ККМ5"
    assert spaced == "ККМ_нет_5"
    known = row.select(keys.content_key(F.lit("abc"))).first()[0]
    assert known == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_labels(apply):
    assert apply(["Омск", "?", None], "string", lambda c: labels.decode(c, {"Омск": "Omsk"})) == ["Omsk", None, None]
    assert apply(["Омск", "?"], "string", lambda c: labels.decode(c, {"Омск": "Omsk"}, True)) == ["Omsk", "?"]
    names = ["Платформа", "Формула", "Вход", None]
    assert apply(names, "string", lambda c: labels.counts_as_ticket(c, "орм")) == [0, 0, 1, 1]
    ranks = [1, 2, 27, 32, 33, None]
    assert apply(ranks, "bigint", lambda c: labels.rank_label(c, RANK_LABELS)) == [
        "a_0", "a_1", "z_26", "ze_31", "33", None,
    ]


def test_unpivoted_numbers_are_made_in_generated_code(spark, tmp_path):
    """Without the fall-back to interpreted code, on a scan of text columns."""
    cells = {"w": ["1", "2"], "a": ["1 000,50", "x"], "b": ["", "16,359.43"], "c d": ["7", None]}
    rows = list(zip(*cells.values(), strict=True))
    spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cells)).write.parquet(str(tmp_path / "t"))
    settings = {"spark.sql.codegen.factoryMode": "CODEGEN_ONLY", "spark.sql.codegen.fallback": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = unpivot_numbers(spark.read.parquet(str(tmp_path / "t")), ["w"], "name", "value").collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert sorted(map(tuple, got)) == [("1", "a", 1000.5), ("1", "c d", 7.0), ("2", "b", 16359.43)]


def test_packed_text_tells_texts_apart(apply):
    texts = ["ab", "AB", "aB", "", "a", "0ab", "00ab", "01ab", "\x01\xab", "\xab", "zz", "0" * 64, None]
    packed = apply(texts, "string", keys.packed_text)
    assert packed[-1] is None and len({bytes(p) for p in packed[:-1]}) == len(texts) - 1
    assert len(packed[-2]) == 33
