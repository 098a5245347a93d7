from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.operators.joins import interval_join_left, left_join_either, spine
from turnstile.operators.totals import labelled_totals
from turnstile.plans.attribution import attributed_checks, attribution_totals

DAY = datetime(2025, 10, 13)


def at(clock, day=DAY):
    h, m, s = (int(x) for x in clock.split(":"))
    return day.replace(hour=h, minute=m, second=s)


@pytest.fixture
def fixture(spark):
    sales = [
        (at("14:21:58"), "Билеты", 2), (at("14:30:00"), "Билеты", 1), (at("15:00:00"), "Билеты", 3),
        (at("16:00:00"), "Билеты", 1), (at("10:00:00", DAY + timedelta(days=1)), "Сувениры", 5),
    ]
    answers = [
        (at("14:22:06"), "Листовки"), (at("14:30:00"), "Смс"), (at("14:30:09"), "Листовки"),
        (at("15:00:01"), "Смс"), (at("15:00:02"), "Листовки"),
    ]
    s = spark.createDataFrame([(*r, "Omsk") for r in sales], "sale_ts timestamp_ntz, item_category string, qty bigint, city string")
    a = spark.createDataFrame([(*r, 1, "Омск") for r in answers], "date timestamp_ntz, value string, qty bigint, city string")
    c = spark.createDataFrame([("Омск", "Omsk")], "name_ru string, name_en string")
    return s, a, c


def test_worked_example(fixture, rows_of):
    got = rows_of(attribution_totals(attributed_checks(*fixture)))
    detail = {"Листовки": (5, 2), "Смс": (4, 2), "Без ответа": (1, None), "Итого": (10, 4)}
    want = [(2025, 42, city, g, *v) for city in ("Omsk", "Итого") for g, v in detail.items()]
    assert got == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])


def test_months(fixture, rows_of):
    got = rows_of(attribution_totals(attributed_checks(*fixture, period="month"), "month"), "year", "month", "total_tickets")
    assert (2025, 10, 10) in got


def brute_force(sales, answers, cities, seconds):
    """The same checks by comparing every sale with every answer."""
    out = {}
    for ts, category, qty, city in sales:
        if category != "Билеты":
            continue
        for ru, en in cities:
            if en != city:
                continue
            hits = [a for a in answers if a[3] == ru and a[0] is not None and ts <= a[0] <= ts + timedelta(seconds=seconds)]
            for _, value, n, _ in hits or [(None, None, None, None)]:
                second = (ts + timedelta(microseconds=500_000)).replace(microsecond=0)
                iso = ts.isocalendar()
                key = (ts.year, iso[1], city, value or "Без ответа", f"{second}_{city}")
                old = out.get(key, (0, None))
                best = n if old[1] is None else old[1] if n is None else max(old[1], n)
                out[key] = (old[0] + qty, best)
    return sorted(k[:4] + (k[4],) + v for k, v in out.items())


moment = st.builds(
    lambda s, us: DAY + timedelta(seconds=s, microseconds=us),
    st.integers(-40, 40),
    st.sampled_from([0, 0, 0, 499_999, 500_000, 999_999]),
)
city_ru = st.sampled_from(["Омск", "Москва", "Яхрома", "Нигде"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sales=st.lists(st.tuples(moment, st.sampled_from(["Билеты", "Билеты", "Кафе"]), st.integers(0, 5), st.sampled_from(["Omsk", "Moscow", "Ufa"])), min_size=1, max_size=60),
    answers=st.lists(st.tuples(moment, st.sampled_from(["Смс", "Листовки", None]), st.integers(1, 3), city_ru), min_size=1, max_size=60),
    seconds=st.sampled_from([0, 1, 8]),
)
def test_checks_equal_brute_force(spark, sales, answers, seconds):
    cities = [("Омск", "Omsk"), ("Москва", "Moscow"), ("Яхрома", "Moscow")]
    s = spark.createDataFrame(sales, "sale_ts timestamp_ntz, item_category string, qty bigint, city string")
    a = spark.createDataFrame(answers, "date timestamp_ntz, value string, qty bigint, city string")
    c = spark.createDataFrame(cities, "name_ru string, name_en string")
    checks = attributed_checks(s, a, c, seconds=seconds)
    got = checks.select("year", "week", "city", "value_group", "check_id", "qty_tickets", "qty_answers")
    assert sorted(tuple(r) for r in got.collect()) == brute_force(sales, answers, cities, seconds)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lefts=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), moment)), min_size=1, max_size=40),
    rights=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), moment)), min_size=1, max_size=40),
    seconds=st.integers(0, 30),
    salts=st.sampled_from([1, 3]),
)
def test_interval_join_equals_nested_loop(spark, lefts, rights, seconds, salts):
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(lefts)], "i int, k string, t timestamp_ntz")
    right = spark.createDataFrame([(i, *r) for i, r in enumerate(rights)], "j int, k2 string, t2 timestamp_ntz")
    joined = interval_join_left(left, right, {"k": "k2"}, "t", "t2", seconds, salts=salts)
    got = sorted((r["i"], -1 if r["j"] is None else r["j"]) for r in joined.collect())
    want = []
    for i, (k, t) in enumerate(lefts):
        hits = [
            j for j, (k2, t2) in enumerate(rights)
            if None not in (k, t, k2, t2) and k == k2 and t <= t2 <= t + timedelta(seconds=seconds)
        ]
        want += [(i, j) for j in hits or [-1]]
    assert got == sorted(want)


def test_a_crowded_instant_is_summed_before_it_is_joined(spark):
    """A third of all rows in one second of one city: 6 * 10**10 pairs that are never formed."""
    n, m = 300_000, 200_000
    hot = lambda i: F.when(i % 3 == 0, F.lit(0)).otherwise(i)
    time = lambda i: F.lit(DAY.isoformat(" ")).cast("timestamp_ntz") + F.make_dt_interval(secs=hot(i).cast("decimal(18,6)"))
    city = lambda i, names: F.when(i % 3 == 0, F.lit(names[0])).otherwise(F.lit(names[1]))
    i = F.col("id")
    sales = spark.range(n).select(time(i).alias("sale_ts"), F.lit("Билеты").alias("item_category"), F.lit(1).cast("long").alias("qty"), city(i, ("Omsk", "Ufa")).alias("city"))
    answers = spark.range(m).select(time(i).alias("date"), F.lit("Смс").alias("value"), F.lit(1).cast("long").alias("qty"), city(i, ("Омск", "Уфа")).alias("city"))
    cities = spark.createDataFrame([("Омск", "Omsk"), ("Уфа", "Ufa")], "name_ru string, name_en string")
    totals = attribution_totals(attributed_checks(sales, answers, cities)).where("city = 'Omsk' AND value_group = 'Смс'")
    row = totals.first()
    assert (row["total_tickets"], row["total_ads_qty"]) == ((n // 3) * -(-m // 3), 1)


def test_interval_join_extra_condition(spark, rows_of):
    left = spark.createDataFrame([(1, "a", DAY, "x"), (2, "a", DAY, "y")], "i int, k string, t timestamp_ntz, kind string")
    right = spark.createDataFrame([(7, "a", DAY)], "j int, k2 string, t2 timestamp_ntz")
    joined = interval_join_left(left, right, {"k": "k2"}, "t", "t2", 8, F.col("kind") == "x")
    assert rows_of(joined, "i", "j") == [(1, 7), (2, None)]


def test_either_name_matches_once(spark, rows_of):
    left = spark.createDataFrame(
        [(1, "Omsk", "Омск"), (1, "Ufa", "Ufa"), (1, "Kazan", None), (2, "Omsk", "Омск"), (1, None, None)],
        "w int, en string, ru string",
    )
    right = spark.createDataFrame(
        [(1, "Omsk", 10), (1, "Омск", 20), (1, "Ufa", 30), (1, None, 40)], "w int, city string, budget int"
    )
    got = rows_of(left_join_either(left, right, ["w"], ("en", "ru"), "city"), "w", "en", "budget")
    assert got == [(1, None, None), (1, "Kazan", None), (1, "Omsk", 10), (1, "Omsk", 20), (1, "Ufa", 30), (2, "Omsk", None)]


def test_spine_is_dense(spark, rows_of):
    members = spark.createDataFrame([("A",), ("B",)], "city string")
    weeks = spark.createDataFrame([(1, 1), (1, 2), (1, 1)], "year int, week int")
    got = rows_of(spine(members, weeks, ["year", "week"], ["x", "y"], spread_by="city"))
    assert got == [(1, w, c, ch) for w in (1, 2) for c in ("A", "B") for ch in ("x", "y")]
    none = spine(members, weeks.where("year = 9"), ["year", "week"], ["x"])
    assert none.count() == 0


def test_totals_keep_missing_apart_from_totals(spark, rows_of):
    df = spark.createDataFrame([(1, None, "x", 5), (1, "A", "x", 7), (1, "A", "y", None)], "p int, city string, g string, n int")
    got = rows_of(labelled_totals(df, ["p"], ["city", "g"], {"n": "n"}, "ALL", {(): "everything", ("city",): "city"}))
    assert (1, None, "x", 5, None) in got
    assert (1, "ALL", "ALL", 12, "everything") in got
    assert (1, None, "ALL", 5, "city") in got
    assert (1, "A", "y", None, None) in got
    assert len(got) == 3 + 2 + 2 + 1


def test_grand_total_is_sum_of_details(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("p"), (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 5).cast("string").alias("b"), "id"
    )
    cube = labelled_totals(df, ["p"], ["a", "b"], {"n": "id"}, "ALL")
    details = cube.where("a <> 'ALL' AND b <> 'ALL'").agg(F.sum("n")).first()[0]
    whole = cube.where("a = 'ALL' AND b = 'ALL'").agg(F.sum("n")).first()[0]
    assert details == whole == sum(range(500))


def test_schema_names():
    assert schemas.RECEIPTS.names[0] == "hash_256" and len(schemas.ONLINE_SALES.names) == 16
