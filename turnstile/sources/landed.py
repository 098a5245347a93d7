"""Readers of landed files: receipts, survey answers, budget sheets, order documents.

Files are read as text with an explicit schema.  A run stamps its load time
once, as an argument, so that a rerun of the same plan gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from turnstile.constants import ANSWER_HEADINGS, RECEIPT_HEADINGS, SHEET_CHANNEL
from turnstile.functions.keys import answer_key, receipt_key
from turnstile.functions.numbers import unreadable
from turnstile.functions.times import day_first_timestamp, till_timestamp
from turnstile.schemas import MONEY, ORDER_DOCUMENT, QTY
from turnstile.sources.tables import hand_over


def load_stamp(loaded_at: datetime) -> Column:
    return F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def clean_landed(df: DataFrame, headings: Mapping[str, str], required: str) -> DataFrame:
    """Drop rows without the required (landed) column, then rename."""
    return df.where(F.col(f"`{required}`").isNotNull()).withColumnsRenamed(dict(headings))


def whole_files_only(df: DataFrame, bad_row: Column, file: str = "file_name") -> DataFrame:
    """Leave out every row of a file (or other unit) that has a bad row: it is taken whole or not at all.

    The names of the bad files are stored first.  The planner then knows how
    few they are and leaves the rows where they are; a list too long to
    broadcast is joined by shuffling.
    """
    bad_files = hand_over(df.where(bad_row).select(F.col(file)).distinct(), "bad-files")
    return df.join(bad_files, file, "left_anti")


class Landing(NamedTuple):
    """Rows that were taken, and what was not: one row per bad line or heading."""

    rows: DataFrame
    rejects: DataFrame  # file_path, line, reason


def landed_lines(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return lines_with_place(spark.read.option("pathGlobFilter", glob).text(folder))


def lines_with_place(lines: DataFrame) -> DataFrame:
    """Lines of text files with the full path, the name and the place of their file's part."""
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_start"),
    )


def _cells(line: str, n: int) -> Column:
    """An array of one struct, for ``inline``: the n cells of a line, and whether it has another number."""
    fields = ", ".join([*[f"c{i} string" for i in range(n)], "__bad string"])
    own = F.array(F.from_csv(line, fields, {"columnNameOfCorruptRecord": "__bad"}))
    return F.transform(own, lambda p: F.struct(F.array(*[p[f"c{i}"] for i in range(n)]).alias("__cells"), p["__bad"].isNotNull().alias("bad")))


def by_heading(lines: DataFrame, headings: Mapping[str, str]) -> Landing:
    """Lines of CSV files with their cells under the wanted landed columns, found by each file's own heading.

    The order of columns and further columns do not matter.  A file that lacks a
    wanted column, or has one twice, is rejected as a whole.  A line that does
    not have as many cells as its heading has ``bad`` set.  The headings are
    stored first, one row a file; the lines stay where they are.
    """
    placed = lines.where("file_start = 0").withColumn("__at", F.monotonically_increasing_id())
    first = placed.groupBy("file_path").agg(F.min_by("line", "__at").alias("__heading"))
    cells = F.split(F.regexp_replace("__heading", "^\ufeff", ""), ",")
    first = first.withColumn("__names", F.transform(cells, lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")))
    missing = F.array_except(F.array(*[F.lit(h) for h in headings]), "__names")
    reason = F.when(F.size(missing) > 0, F.concat(F.lit("no column "), F.array_join(missing, ", ")))
    reason = reason.when(F.size("__names") != F.size(F.array_distinct("__names")), F.lit("a column twice"))
    first = hand_over(first.withColumn("__reason", reason), "headings")
    rejects = first.where("__reason is not null").select("file_path", F.col("__heading").alias("line"), F.col("__reason").alias("reason"))
    # As many distinct widths as kinds of files, not as files.
    widths = sorted(r[0] for r in first.where("__reason is null").select(F.size("__names")).distinct().collect())
    parsed = F.array(F.struct(F.array().cast("array<string>").alias("__cells"), F.lit(True).alias("bad")))
    for n in widths:
        parsed = F.when(F.size("__names") == n, _cells("line", n)).otherwise(parsed)
    rows = lines.join(first.where("__reason is null"), "file_path").where((F.col("line") != F.col("__heading")) & (F.trim("line") != ""))
    rows = rows.select("file_path", "file_name", "line", "__names", F.inline(parsed))
    found = [F.try_element_at("__cells", F.array_position("__names", F.lit(h)).cast("int")).alias(h) for h in headings]
    return Landing(rows.select(*found, "file_path", "file_name", "line", "bad"), rejects)


def _without(landing: Landing, reason: Column, whole_files: bool) -> Landing:
    """Set the rows with a reason aside; with ``whole_files`` every other row of their files is left out too."""
    judged = landing.rows.withColumn("__reason", reason)
    faults = hand_over(judged.where("__reason is not null").select("file_path", "line", F.col("__reason").alias("reason")), "rejects")
    rows = judged.where("__reason is null").drop("__reason")
    if whole_files:
        rows = rows.join(faults.select("file_path"), "file_path", "left_anti")
    return Landing(rows, landing.rejects.unionByName(faults))


def _line_fault() -> Column:
    return F.when(F.col("bad"), "not as many cells as the heading")


def shape_receipts(lines: DataFrame, loaded_at: datetime, whole_files: bool = True) -> Landing:
    """Landed receipt lines to typed, keyed receipts.

    The time has one strict format.  A file with a broken line, with a time in
    another format, or with a quantity or amount that is no number, is left out
    whole, or only its bad rows with ``whole_files=False``; the rejects tell.
    """
    landed, rejects = by_heading(lines, RECEIPT_HEADINGS)
    rows = landed.where(F.col("`Запасы.Сумма`").isNotNull() | F.col("bad")).withColumnsRenamed(dict(RECEIPT_HEADINGS))
    rows = rows.withColumnsRenamed({"sale_date": "__time"})
    rows = rows.withColumn("sale_date", till_timestamp("__time"))
    reason = (
        _line_fault()
        .when(F.col("__time").isNotNull() & F.col("sale_date").isNull(), "unreadable time")
        .when(unreadable("qty", QTY) | unreadable("amount", MONEY), "unreadable number")
    )
    rows, rejects = _without(Landing(rows, rejects), reason, whole_files)
    rows = rows.withColumns(
        {
            "qty": F.col("qty").try_cast(QTY),
            "amount": F.col("amount").try_cast(MONEY),
            "load_dttm": load_stamp(loaded_at),
            "hash_256": receipt_key(),
        }
    )
    rows = rows.select(
        "hash_256", "sale_date", "kkm", "receipt_id", "receipt_name", "item_category",
        "itenm_id", "item", "qty", "amount", "load_dttm",
    )
    return Landing(rows, rejects)


def read_receipts(
    spark: SparkSession, folder: str, loaded_at: datetime, glob: str = "*.csv", whole_files: bool = True
) -> Landing:
    """Receipts of every matching file of a folder.  Cancelled ones differ by folder only."""
    return shape_receipts(landed_lines(spark, folder, glob), loaded_at, whole_files)


def shape_answers(lines: DataFrame, loaded_at: datetime) -> Landing:
    """Landed survey lines to typed, keyed answers with the name of their file."""
    landed, rejects = by_heading(lines, ANSWER_HEADINGS)
    rows = landed.where(F.col("`Период`").isNotNull() | F.col("bad")).withColumnsRenamed(dict(ANSWER_HEADINGS))
    rows = rows.withColumn("__parsed", day_first_timestamp("date"))
    reason = _line_fault().when(F.col("__parsed").isNull(), "unreadable time").when(unreadable("qty", "bigint"), "unreadable number")
    rows, rejects = _without(Landing(rows, rejects), reason, True)
    rows = rows.withColumn("date", F.col("__parsed")).select(
        answer_key().alias("id"),
        "date",
        "value",
        F.col("qty").try_cast("bigint").alias("qty"),
        "city",
        "file_name",
        load_stamp(loaded_at).alias("load_dttm"),
    )
    return Landing(rows, rejects)


def read_answers(spark: SparkSession, folder: str, loaded_at: datetime, glob: str = "*.csv") -> Landing:
    return shape_answers(landed_lines(spark, folder, glob), loaded_at)


def _read_sheet(spark: SparkSession, sheet_id: str, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    order = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.withColumns({"__sheet": F.lit(sheet_id), "__order": order})


def read_budget_sheets(
    spark: SparkSession, sheets: Mapping[str, str], required: str
) -> tuple[list[DataFrame], list[str]]:
    """Each landed sheet as all-text rows with its ``channel``, and the ids of bad sheets.

    A sheet is one small file with its own city columns, so sheets are read one
    by one.  The channel is that of the sheet's first data row, for the whole
    sheet; a sheet without such a column is ``Channel_<sheet id>``.  A sheet
    without the ``required`` date column, or one that cannot be opened, is
    skipped and reported.
    """
    good, bad = [], []
    for sheet_id, path in sheets.items():
        try:
            rows = _read_sheet(spark, sheet_id, path)
        except AnalysisException as problem:  # anything else, such as a storage that is down, ends the run
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            bad.append(sheet_id)
            continue
        if required not in rows.columns:
            bad.append(sheet_id)
            continue
        if SHEET_CHANNEL in rows.columns:
            first = rows.groupBy("__sheet").agg(F.min_by(SHEET_CHANNEL, "__order").alias("channel"))
            rows = rows.join(first, "__sheet")
        else:
            rows = rows.withColumn("channel", F.lit(f"Channel_{sheet_id}"))
        good.append(rows.drop("__sheet", "__order"))
    return good, bad


def read_order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Order documents landed as JSON lines in folders ``event_id=<id>``.

    ``landed_at`` is the time of the file, which tells the newer of two states
    of an order.  A line that is no whole document is in ``broken``. 
    """
    schema = StructType([*ORDER_DOCUMENT, StructField("broken", StringType()), StructField("event_id", StringType())])
    documents = spark.read.schema(schema).option("columnNameOfCorruptRecord", "broken").json(folder)
    return documents.withColumns({"file_path": F.col("_metadata.file_path"), "landed_at": F.col("_metadata.file_modification_time")})


def parse_order_documents(df: DataFrame, text: str, event_id: str) -> DataFrame:
    """Order documents held as JSON text in a column.

    ``inline`` parses a text once.  As a plain projection the parse would be
    repeated in every filter that the optimizer moves below it.
    """
    return df.select(
        F.col(event_id).alias("event_id"), F.inline(F.array(F.from_json(text, ORDER_DOCUMENT)))
    )


def active_cities(cities: DataFrame) -> DataFrame:
    """Cities in operation with their event, the list the order ingest runs over."""
    return cities.where("is_active").select("event_id", F.col("name_en").alias("city"))
