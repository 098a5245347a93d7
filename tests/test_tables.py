import hashlib
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.constants import RECEIPT_HEADINGS
from turnstile.plans.answers import daily_answers, latest_answers, new_daily_answers
from turnstile.schemas import RECEIPTS
from turnstile.session import shared_folder
from turnstile.sources import tables
from turnstile.sources.landed import shape_receipts
from turnstile.sources.tables import (
    _touched,
    append_table,
    hand_over,
    insert_if_absent,
    read_table,
    replace_periods,
    replace_table,
    spread_if_few,
    upsert,
    write_absent,
    write_upsert,
)
from turnstile.streaming.ingest import ingest_new_files, landing_stream

SCHEMA = T.StructType(
    [T.StructField("day", T.StringType()), T.StructField("k", T.LongType()), T.StructField("v", T.LongType())]
)
batch_rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), min_size=1, max_size=25)


def keyed(rows):
    return [(f"d{k % 3}", k, v) for k, v in rows]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=batch_rows, new=batch_rows)
def test_keyed_writes_are_idempotent(spark, old, new):
    empty = spark.createDataFrame([], SCHEMA)
    order = [F.col("v").desc()]
    a, b = (spark.createDataFrame(keyed(r), SCHEMA) for r in (old, new))
    first = insert_if_absent(empty, a, ["k"], order)
    for apply, wins in ((insert_if_absent, old), (upsert, new)):
        once = apply(first, b, ["k"], order)
        twice = apply(once, b, ["k"], order)
        got = {r["k"]: r["v"] for r in once.collect()}
        assert got == {r["k"]: r["v"] for r in twice.collect()}
        assert once.count() == len(got)
        best = {k: max(v for k2, v in wins if k2 == k) for k, _ in wins}
        assert all(got[k] == v for k, v in best.items())
        assert set(got) == {k for k, _ in old + new}


def test_stored_upsert_touches_only_its_partitions(spark, tmp_path, rows_of):
    path, order = str(tmp_path / "t"), [F.col("v").desc()]
    write_upsert(spark, path, SCHEMA, spark.createDataFrame(keyed([(1, 1), (2, 2), (3, 3)]), SCHEMA), ["k"], order, "day")
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=*/*.parquet")}
    batch = spark.createDataFrame(keyed([(1, 9), (4, 4), (4, 5)]), SCHEMA)
    for _ in range(2):
        write_upsert(spark, path, SCHEMA, batch, ["k"], order, "day")
        assert rows_of(read_table(spark, path, SCHEMA), "k", "v") == [(1, 9), (2, 2), (3, 3), (4, 5)]
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=*/*.parquet")}
    assert len(set(before.items()) & set(after.items())) == 2


def test_partition_without_value_survives(spark, tmp_path, rows_of):
    path, order = str(tmp_path / "t"), [F.col("v").desc()]
    for rows in ([(None, 1, 1), ("a", 2, 2)], [(None, 3, 3)], [(None, 1, 4)]):
        write_upsert(spark, path, SCHEMA, spark.createDataFrame(rows, SCHEMA), ["k"], order, "day")
    assert rows_of(read_table(spark, path, SCHEMA), "k", "v") == [(1, 4), (2, 2), (3, 3)]
    for _ in range(2):
        write_absent(spark, path, SCHEMA, spark.createDataFrame([(None, 1, 9), ("a", 5, 5)], SCHEMA), ["k"], order, "day")
    assert rows_of(read_table(spark, path, SCHEMA), "k", "v") == [(1, 4), (2, 2), (3, 3), (5, 5)]


def test_absent_rows_append_replace(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    assert read_table(spark, path, SCHEMA).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, path)
    batch = spark.createDataFrame(keyed([(1, 1), (1, 2)]), SCHEMA)
    for _ in range(2):
        write_absent(spark, path, SCHEMA, batch, ["k"], [F.col("v")])
    assert rows_of(read_table(spark, path), "k", "v") == [(1, 1)]
    append_table(batch, path)
    assert read_table(spark, path).count() == 3
    replace_table(batch, path)
    assert read_table(spark, path).count() == 2


def test_insert_hands_over_keys_alone(spark, tmp_path, rows_of, monkeypatch):
    """Rows of the batch are stored nowhere but in the table; repeated keys, null keys and keys of the table are told apart."""
    path, handed = str(tmp_path / "t"), []
    monkeypatch.setattr(tables, "hand_over", lambda df, name: handed.append(df.columns) or hand_over(df, name))
    text = T.StructType([T.StructField("day", T.StringType()), T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    made = {"k": F.when(F.col("day") != "n", F.sha2("day", 256))}
    digest = {day: hashlib.sha256(day.encode()).hexdigest() for day in "abc"}
    for days, wanted in (("aabn", [("a", 1), ("b", 3), ("n", 4)]), ("ccban", [("a", 1), ("b", 3), ("c", 1), ("n", 4), ("n", 5)])):
        rows = [(day, digest.get(day), v) for v, day in enumerate(days, 1)]
        write_absent(spark, path, text, spark.createDataFrame(rows, text), ["k"], [F.col("v")], "day", made)
        assert rows_of(read_table(spark, path, text), "day", "k", "v") == sorted(
            [(day, digest.get(day), v) for day, v in wanted], key=lambda t: [(x is not None, str(x)) for x in t]
        )
    assert handed and not any("v" in columns for columns in handed)


def test_older_batch_rewrites_nothing(spark, tmp_path, rows_of):
    """A batch of no newer version leaves every file of a keyed table; a tie or a new key writes."""
    path, order = str(tmp_path / "t"), [F.col("v").desc_nulls_last()]
    files = lambda: {p.name for p in (tmp_path / "t").glob("key_bucket=*/*.parquet")}
    load = lambda rows: tables.write_keyed_upsert(spark, path, SCHEMA, spark.createDataFrame(rows, SCHEMA), ["k"], order, "v")
    load([("new", 1, 5), ("new", 1, 4), ("new", 2, 6), ("new", 3, None)])
    first = files()
    load([("old", 1, 3), ("old", 1, None), ("old", 2, 5)])
    assert files() == first
    load([("late", 1, 5), ("old", 2, 5), ("late", 3, None), ("late", 4, 1)])
    assert first.isdisjoint(files())
    held = [("late", 1, 5), ("new", 2, 6), ("late", 3, None), ("late", 4, 1)]
    assert sorted(rows_of(read_table(spark, path, SCHEMA), "k", "day")) == [(k, day) for day, k, _ in held]


@pytest.mark.parametrize("few", [0, 1, 500_000])
def test_first_where_repeated_is_one_per_key(spark, rows_of, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW_KEYS", few)
    batch = spark.createDataFrame([("d", 1, 3), ("d", 1, 2), ("d", 2, 5), ("d", None, 9), ("d", None, 8), ("d", 4, 4)], SCHEMA)
    order = [F.col("v")]
    assert rows_of(tables.first_where_repeated(batch, ["k"], order)) == rows_of(tables.one_per_key(batch, ["k"], order))


def test_replace_periods(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    replace_periods(spark.createDataFrame(keyed([(1, 1), (2, 2)]), SCHEMA), path, ["day"])
    replace_periods(spark.createDataFrame(keyed([(1, 7)]), SCHEMA), path, ["day"])
    assert rows_of(read_table(spark, path, SCHEMA), "k", "v") == [(1, 7), (2, 2)]


def test_hand_over_keeps_rows_and_types(spark):
    df = spark.range(10).select("id", F.col("id").cast("decimal(18,2)").alias("d"))
    stored = hand_over(df, "numbers")
    assert stored.schema == df.schema or stored.dtypes == df.dtypes
    assert stored.agg(F.sum("d")).first()[0] == 45


def test_spread_only_where_splits_are_few(spark):
    few, many = spark.range(100).coalesce(1), spark.range(0, 100, 1, 16)
    assert spread_if_few(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread_if_few(many) is many


VERSIONS = [
    (datetime(2025, 11, 6, 10), "Омск", "Смс", 1, datetime(2025, 11, 6, 12)),
    (datetime(2025, 11, 6, 10), "Омск", "Смс", 3, datetime(2025, 11, 6, 13)),
    (datetime(2025, 11, 6, 11), "Омск", "Смс", 4, datetime(2025, 11, 6, 12)),
    (datetime(2025, 11, 6, 11), "Омск", "Сайт парка (в котором находится наш объект)", 2, datetime(2025, 11, 6, 12)),
    (datetime(2025, 11, 5, 11), "Омск", "Неизвестный", 2, datetime(2025, 11, 6, 12)),
    (datetime(2025, 11, 7, 11), "Где-то", "Смс", 2, datetime(2025, 11, 6, 12)),
]


def test_daily_answers(spark, rows_of):
    versions = spark.createDataFrame(VERSIONS, "date timestamp_ntz, city string, value string, qty bigint, load_dttm timestamp_ntz")
    cities = spark.createDataFrame([("Омск", "Omsk"), ("Москва", "Moscow"), ("Яхрома", "Moscow")], "name_ru string, name_en string")
    assert latest_answers(versions).count() == 5
    daily = daily_answers(versions, cities)
    assert len(daily.columns) == 26
    days = daily.select(F.col("day").cast("string"), "city", "Смс", F.col("Сайт парка (в котором находится на").alias("site"))
    assert rows_of(days) == [
        ("2025-11-05", "Omsk", 0, 0), ("2025-11-06", "Omsk", 7, 2), ("2025-11-07", None, 2, 0),
    ]
    target = daily.where("city = 'Omsk' AND day = date'2025-11-06'").select("day", "city")
    new = new_daily_answers(daily, target, date(2025, 11, 5))
    assert rows_of(new.select(F.col("day").cast("string"), "city")) == [("2025-11-07", None)]


def test_failed_replace_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        replace_table(broken, path)
    assert read_table(spark, path).count() == 3
    replace_table(read_table(spark, path).where("id > 0"), path)
    assert read_table(spark, path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_replace_switches_by_a_pointer_written_last(spark, tmp_path):
    from turnstile.sources.tables import VERSIONS, current_folder

    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)  # a table from before pointers
    replace_table(spark.range(3), path, [])
    early = read_table(spark, path)  # resolved now, read later
    # Rows written but no pointer yet (the writer stopped between the two steps): readers see the old table whole.
    spark.range(100).write.parquet(f"{path}/v-unfinished")
    assert read_table(spark, path).count() == 3
    replace_table(spark.range(5), path)
    assert read_table(spark, path).count() == 5 and early.count() == 3  # the version before stays for late readers
    replace_table(spark.range(6), path)
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    assert read_table(spark, path).count() == 6 and len(names) == 3 and VERSIONS in names  # pointers, this version and the one before
    assert len([p for p in (tmp_path / "t" / VERSIONS).iterdir() if not p.name.startswith(".")]) == 2  # the local file system adds .crc files
    assert current_folder(spark, path).startswith(path + "/v-")


def test_late_row_opens_its_own_partitions_only(spark, tmp_path):
    rows = spark.createDataFrame([(k, k, date(2025, 10, k)) for k in range(1, 29)], "k int, v int, day date")
    replace_periods(rows, str(tmp_path / "t"), ["day"])
    batch = spark.createDataFrame([(2, 0, date(2025, 10, 2)), (27, 0, date(2025, 10, 27))], rows.schema)
    touched = _touched(read_table(spark, str(tmp_path / "t"), rows.schema), batch, "day")
    assert len(touched.inputFiles()) == 28 and touched.count() == 2
    assert "PartitionFilters: [day#" in touched._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=*/*.parquet")}
    write_upsert(spark, str(tmp_path / "t"), rows.schema, batch, ["k"], [F.col("v")], "day")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=*/*.parquet")}
    assert len(set(before) & set(after)) == 26
    assert read_table(spark, str(tmp_path / "t")).agg(F.sum("v")).first()[0] == sum(range(1, 29)) - 29


def test_a_cluster_without_a_shared_folder_is_refused():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_streaming_ingest_equals_batch(spark, tmp_path, rows_of):
    landing = tmp_path / "landing"
    landing.mkdir()
    heading = list(RECEIPT_HEADINGS)
    path, progress, stamp = str(tmp_path / "receipts"), str(tmp_path / "progress"), datetime(2025, 11, 6)

    def land(name, items):
        rows = [f"13.10.2025 14:21:5{i % 10},ККМ (Ростов),q,Чек,Билеты,{i},Вход,1,{i}.00" for i in items]
        (landing / name).write_text("\n".join([",".join(heading), *rows]) + "\n", encoding="utf-8")

    def shape(batch):
        return shape_receipts(batch, stamp)

    def run():
        source = landing_stream(spark, str(landing), "*.csv")
        ingest_new_files(
            spark, source, shape, path, RECEIPTS, ["hash_256"], [F.col("amount")], progress
        ).awaitTermination()
        return rows_of(read_table(spark, path), "itenm_id", "amount")

    land("a.csv", [1, 2, 2])
    assert [r[0] for r in run()] == ["1", "2"]
    land("b.csv", [2, 3])
    assert [r[0] for r in run()] == ["1", "2", "3"]
    assert [r[0] for r in run()] == ["1", "2", "3"]


def test_keyed_upsert_rewrites_only_files_holding_batch_keys(spark, tmp_path):
    from turnstile.sources.tables import BUCKET, KEY_BUCKETS, handed_over_within, write_keyed_upsert

    path = str(tmp_path / "keyed")
    schema = "k string, v long, day date, landed long"
    import datetime as dt

    rows = [(f"k{i}", i, dt.date(2015, 1, 1) + dt.timedelta(days=i), 1) for i in range(3000)]  # eight years of days
    with handed_over_within(spark):
        write_keyed_upsert(spark, path, spark.createDataFrame(rows, schema).schema, spark.createDataFrame(rows, schema), ["k"], [F.col("landed").desc()], "landed", ["day"])
    folders = [p.name for p in (tmp_path / "keyed").iterdir() if p.name.startswith(BUCKET)]
    assert 0 < len(folders) <= KEY_BUCKETS
    files_before = {str(p) for p in (tmp_path / "keyed").rglob("*.parquet")}
    # A batch of two keys: one newer, one late and older, and one new key.
    batch = spark.createDataFrame([("k5", 50, dt.date(2015, 1, 6), 2), ("k7", 70, dt.date(2015, 1, 8), 0), ("new", 9, None, 2)], schema)
    with handed_over_within(spark):
        write_keyed_upsert(spark, path, batch.schema, batch, ["k"], [F.col("landed").desc()], "landed", ["day"])
    table = spark.read.parquet(path)
    got = {r["k"]: r["v"] for r in table.collect()}
    assert len(got) == table.count() == 3001
    assert (got["k5"], got["k7"], got["new"]) == (50, 7, 9)
    files_after = {str(p) for p in (tmp_path / "keyed").rglob("*.parquet")}
    kept = files_before & files_after
    touched = {r[0] for r in spark.createDataFrame([("k5",), ("k7",), ("new",)], "k string").select(F.pmod(F.xxhash64("k"), F.lit(KEY_BUCKETS))).collect()}
    assert all(int(f.split(f"{BUCKET}=")[1].split("/")[0]) in touched for f in files_before - kept)
    assert len(kept) >= len(files_before) - 2  # at most the files of k5 and k7 were replaced
    # The same batch again changes nothing.
    with handed_over_within(spark):
        write_keyed_upsert(spark, path, batch.schema, batch, ["k"], [F.col("landed").desc()], "landed", ["day"])
    assert spark.read.parquet(path).count() == 3001


def test_runs_in_threads_keep_their_own_staged_folders(spark):
    """A run that ends deletes only what it handed over itself, not the folders of a run beside it."""
    import threading

    from turnstile.sources.tables import hand_over, handed_over_within

    first_done, second_ready, counts = threading.Event(), threading.Event(), {}

    def first():
        second_ready.wait(120)
        with handed_over_within(spark):
            counts["first"] = hand_over(spark.range(3), "first").count()
        first_done.set()

    def second():
        with handed_over_within(spark):
            rows = hand_over(spark.range(5), "second")
            second_ready.set()
            first_done.wait(120)
            counts["second"] = rows.count()  # still readable after the first run ended

    threads = [threading.Thread(target=first), threading.Thread(target=second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(300)
    assert counts == {"first": 3, "second": 5}


def test_folders_written_side_by_side_belong_to_the_run(spark):
    import glob

    from turnstile.session import shared_folder
    from turnstile.sources.tables import hand_over_all, handed_over_within

    folder = shared_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/*"))
    with handed_over_within(spark):
        a, b = hand_over_all({"side-a": spark.range(2), "side-b": spark.range(4)})
        assert (a.count(), b.count()) == (2, 4)
    assert set(glob.glob(f"{folder}/*")) == before, "both folders are deleted with the run"
