"""The runs that move data from the landing folders to the report.

Each run reads stored tables and writes one; any of them may be repeated.
``loaded_at`` and ``as_of`` are arguments, never the clock.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from turnstile import schemas
from turnstile.constants import MART_CHANNELS, TILL_TO_CITY
from turnstile.functions.keys import order_line_key, receipt_key
from turnstile.functions.times import calendar_year, iso_week, loose_date, whole_periods
from turnstile.operators.quality import ingest_summary, key_uniqueness, values_outside
from turnstile.plans.answers import daily_answers, new_daily_answers
from turnstile.plans.attribution import attributed_checks, attribution_totals
from turnstile.plans.budgets import (
    monthly_budget_rows,
    prepared_budgets,
    prepared_budgets_month,
    weekly_budget_rows,
)
from turnstile.plans.offline import offline_sales
from turnstile.plans.orders import order_lines, rows_of_order, unreadable_amounts
from turnstile.plans.report import last_week, report_lines, report_rows
from turnstile.plans.revenue import revenue_by_source, week_over_week, weekly_revenue
from turnstile.plans.weekly import weekly_mart
from turnstile.sources.landed import (
    Landing,
    active_cities,
    load_stamp,
    read_answers,
    read_budget_sheets,
    read_order_documents,
    read_receipts,
    shape_receipts,
    whole_files_only,
)
from turnstile.sources.tables import (
    append_table,
    current_folder,
    delete_folders,
    hand_over,
    handed_over_within,
    read_table,
    replace_periods,
    replace_table,
    write_absent,
    write_keyed_upsert,
    write_upsert,
)
from turnstile.streaming.ingest import ingest_new_files, landing_stream


def _with_day(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind, True)])


RECEIPT_TABLE = _with_day(schemas.RECEIPTS, "sale_day", T.DateType())
ANSWER_TABLE = _with_day(schemas.ANSWERS, "answer_day", T.DateType())
ONLINE_TABLE = _with_day(_with_day(schemas.ONLINE_SALES, "landed_at", T.TimestampType()), "created_day", T.DateType())


@dataclass(frozen=True)
class Warehouse:
    """A session and the folder that holds one sub-folder per table."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        return read_table(self.spark, self.path(table), schema)


def _first_receipt() -> list[Column]:
    """Order of the rows of one key within a batch, where the files give none."""
    return [F.col(c).asc_nulls_last() for c in ("amount", "qty", "receipt_id", "item", "item_category")]


def _with_sale_day(receipts: DataFrame) -> DataFrame:
    return receipts.withColumn("sale_day", F.to_date("sale_date"))


def _cleans_up(run):
    """What a run hands over to itself is deleted when it ends, also by a failure."""

    @wraps(run)
    def cleaning(w: Warehouse, *args, **kwargs):
        with handed_over_within(w.spark):
            return run(w, *args, **kwargs)

    return cleaning


def _settled(df: DataFrame) -> DataFrame:
    """A short report (one row per unit, file or reason) computed now."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _keep_rejects(w: Warehouse, rejects: DataFrame, loaded_at: datetime) -> DataFrame:
    """Store what was not taken, each line once; gives the number per file and reason."""
    rows = rejects.withColumn("loaded_at", load_stamp(loaded_at)).select(*schemas.REJECTS.names)
    rows = rows.withColumn("line", F.coalesce("line", F.lit("")))
    write_absent(w.spark, w.path("rejects"), schemas.REJECTS, rows, ["file_path", "line", "reason"], [F.col("loaded_at")])
    return _settled(rejects.groupBy("file_path", "reason").agg(F.count(F.lit(1)).alias("line_count")))


@_cleans_up
def load_receipts(w: Warehouse, folder: str, loaded_at: datetime, table: str = "receipts") -> DataFrame:
    """Landed receipts into a table, first write of a key wins; gives the rejected lines per file and reason.

    The day of sale is part of the key, so the table is partitioned by it.
    """
    rows, rejects = read_receipts(w.spark, folder, loaded_at)
    write_absent(
        w.spark, w.path(table), RECEIPT_TABLE, _with_sale_day(rows), ["hash_256"], _first_receipt(), "sale_day",
        {"hash_256": receipt_key()},
    )
    return _keep_rejects(w, rejects, loaded_at)


def load_new_receipts(
    w: Warehouse, folder: str, loaded_at: datetime, table: str = "receipts"
) -> StreamingQuery:
    """The same for files that no earlier run has seen; progress is kept beside the table.

    Rejected lines are in the table of rejects.  A corrected file is landed
    under a new name, or its folder is given to ``load_receipts``.
    """

    def shape(lines: DataFrame) -> Landing:
        rows, rejects = shape_receipts(lines, loaded_at)
        return Landing(_with_sale_day(rows), rejects)

    return ingest_new_files(
        w.spark,
        landing_stream(w.spark, folder, "*.csv"),
        shape,
        w.path(table),
        RECEIPT_TABLE,
        ["hash_256"],
        _first_receipt(),
        w.path(f"{table}_progress"),
        "sale_day",
        lambda rejects: _keep_rejects(w, rejects, loaded_at),
    )


def load_cancelled_receipts(w: Warehouse, folder: str, loaded_at: datetime) -> DataFrame:
    return load_receipts(w, folder, loaded_at, "receipts_cancel")


@_cleans_up
def load_answers(w: Warehouse, folder: str, loaded_at: datetime) -> DataFrame:
    """Landed survey answers into a table, first write of a key wins; gives the rejected lines per file and reason."""
    rows, rejects = read_answers(w.spark, folder, loaded_at)
    rows = rows.withColumn("answer_day", F.to_date("date"))
    first = [F.col("file_name"), F.col("qty").desc_nulls_last()]
    write_absent(w.spark, w.path("answers"), ANSWER_TABLE, rows, ["id"], first, "answer_day")
    return _keep_rejects(w, rejects, loaded_at)


@_cleans_up
def _load_budgets(w, sheets, required, shape, table, schema) -> tuple[DataFrame, list[str]]:
    good, bad = read_budget_sheets(w.spark, sheets, required)
    frames = [shape(sheet) for sheet in good]
    empty = w.spark.createDataFrame([], schema)
    rows = hand_over(reduce(DataFrame.unionByName, frames, empty), "budget-rows")
    # A key holds channel, city and date, so its channel is its partition.
    newest = [F.col("budget").desc(), *[F.col(c) for c in schema.names if c not in ("id", "budget")]]
    write_upsert(w.spark, w.path(table), schema, rows, ["id"], newest, "channel")
    return _settled(key_uniqueness(rows, "id")), bad


def load_week_budgets(w: Warehouse, sheets: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Weekly budget sheets into a table; gives the key report and the sheets skipped."""
    return _load_budgets(w, sheets, "Дата с", weekly_budget_rows, "budgets", schemas.BUDGETS_WEEK)


def load_month_budgets(w: Warehouse, sheets: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    return _load_budgets(w, sheets, "month", monthly_budget_rows, "budgets_month", schemas.BUDGETS_MONTH)


@_cleans_up
def load_orders(w: Warehouse, folder: str, loaded_at: datetime) -> DataFrame:
    """Order documents into the table of online sales, the newest file's state wins; gives the summary.

    An event with a broken document, or with an amount that is no number, is
    left out whole and reported as an ``error``; the others go on.  The files
    are parsed once.
    """
    documents = hand_over(read_order_documents(w.spark, folder), "documents")
    reason = F.when(F.col("broken").isNotNull(), "broken document").when(unreadable_amounts(), "unreadable number")
    faults = documents.withColumn("reason", reason).where("reason is not null")
    documents = whole_files_only(documents, F.col("broken").isNotNull() | unreadable_amounts(), "event_id")
    lines = order_lines(documents, keep=["landed_at"]).withColumn("created_day", F.to_date("created_at"))
    newest = [F.col(c).desc_nulls_last() for c in ("landed_at", "status_name", "payment_amount", "price_nominal")]
    write_keyed_upsert(
        w.spark, w.path("online_sales"), ONLINE_TABLE, lines, ["order_hash"], newest, "landed_at", ["created_day"],
        {"order_hash": order_line_key()},
    )
    _keep_rejects(w, faults.select("file_path", F.coalesce("broken", F.to_json(F.struct("id", "payment", "tickets"))).alias("line"), "reason"), loaded_at)
    units = active_cities(w.read("cities", schemas.CITIES))
    return _settled(ingest_summary(units, "event_id", documents, "event_id", rows_of_order()))


def refresh_offline_sales(w: Warehouse, day: date | None = None) -> None:
    """Receipts (of one day) to offline sales; their days are replaced."""
    receipts = w.read("receipts", RECEIPT_TABLE)
    if day is not None:
        receipts = receipts.where(F.col("sale_day") == F.lit(day.isoformat()).cast("date"))
    sales = offline_sales(receipts).withColumn("sale_day", F.to_date("sale_ts"))
    replace_periods(sales, w.path("offline_sales"), ["sale_day"])


def _offline(w: Warehouse) -> DataFrame:
    return w.read("offline_sales", _with_day(schemas.OFFLINE_SALES, "sale_day", T.DateType()))


Days = tuple[date, date]


def _on(facts: DataFrame, day: str, days: list[date]) -> DataFrame:
    """Facts of the days alone: a filter on the partition column."""
    return facts.where(F.col(day).isin(days))


def _write_periods(rows: DataFrame, path: str, period: str, days: Days | None) -> None:
    """Replace the table, or only the periods that the days are in; a period of these that has lost all its rows is emptied.

    The rows are stored once, as they are written and then asked for their periods.
    """
    if days is None:
        replace_table(rows, path, ["year", period])
        return
    with handed_over_within(rows.sparkSession):
        rows = hand_over(rows, "period-rows")
        replace_periods(rows, path, ["year", period])
        # At most one row per period that the days are in.
        written = {(r[0], r[1]) for r in rows.select("year", period).distinct().collect()}
        covered = {(d.year, d.isocalendar().week if period == "week" else d.month) for d in whole_periods(*days, period)}
        folder = current_folder(rows.sparkSession, path)
        delete_folders(rows.sparkSession, [f"{folder}/year={y}/{period}={p}" for y, p in sorted(covered - written)])


def _read_periods(w: Warehouse, table: str, period: str = "week") -> DataFrame:
    return w.read(table).withColumns({c: F.col(c).cast("long") for c in ("year", period)})


def refresh_sales(w: Warehouse, period: str = "week", days: Days | None = None) -> None:
    """Attributed tickets and answers by week or month, with totals.

    With ``days`` (first and last) only the periods they are in are read and
    replaced; answers of the day after are read too, as they may belong to a
    sale just before midnight.
    """
    sales, answers = _offline(w), w.read("answers", ANSWER_TABLE)
    if days is not None:
        wanted = whole_periods(*days, period)
        sales = _on(sales, "sale_day", wanted)
        answers = _on(answers, "answer_day", sorted({*wanted, *(d + timedelta(1) for d in wanted)}))
    checks = attributed_checks(sales, answers, w.read("cities", schemas.CITIES), period)
    table = {"week": "sales", "month": "sales_month"}[period]
    _write_periods(attribution_totals(checks, period), w.path(table), period, days)


def refresh_budgets(w: Warehouse, period: str = "week") -> None:
    """Prepared budgets by week or month, with totals."""
    if period == "week":
        rows = prepared_budgets(w.read("budgets", schemas.BUDGETS_WEEK), w.read("dates", schemas.DATES))
        replace_table(rows, w.path("prepared_budgets"))
    else:
        rows = prepared_budgets_month(w.read("budgets_month", schemas.BUDGETS_MONTH))
        replace_table(rows, w.path("prepared_budgets_month"))


def refresh_daily_answers(w: Warehouse, after: date | None = None) -> None:
    """Append the days and cities the daily answer table does not hold yet."""
    daily = daily_answers(w.read("answer_versions", schemas.ANSWER_VERSIONS), w.read("cities", schemas.CITIES))
    held = w.read("daily_answers", daily.schema)
    append_table(new_daily_answers(daily, held, after), w.path("daily_answers"))


def refresh_weekly_revenue(w: Warehouse, days: Days | None = None) -> None:
    """Weekly revenue per city with its total row, of all weeks or of those that the days are in."""
    online, offline = w.read("online_sales", ONLINE_TABLE), _offline(w)
    if days is not None:
        wanted = whole_periods(*days, "week")
        online, offline = _on(online, "created_day", wanted), _on(offline, "sale_day", wanted)
    rows = weekly_revenue(online, offline, w.read("cities", schemas.CITIES))
    _write_periods(rows, w.path("weekly_revenue"), "week", days)


@_cleans_up
def refresh_weekly_mart(w: Warehouse, as_of: date) -> None:
    """The weekly mart of the stored sales, budgets and revenue."""
    rows = weekly_mart(
        _read_periods(w, "sales"), w.read("prepared_budgets"), _read_periods(w, "weekly_revenue"),
        w.read("cities", schemas.CITIES), as_of,
    )
    replace_table(rows, w.path("weekly_mart"))


def tills_without_city(w: Warehouse) -> DataFrame:
    """Tills of the receipts that belong to no city, with rows and amount."""
    return values_outside(w.read("receipts", RECEIPT_TABLE), "kkm", list(TILL_TO_CITY), "amount")


def channels_outside_mart(w: Warehouse) -> DataFrame:
    """Channels of the prepared budgets that count in the mart's totals only."""
    return values_outside(w.read("prepared_budgets"), "channel", MART_CHANNELS, "current_week")


def budgets_without_date(w: Warehouse, period: str = "week") -> DataFrame:
    """Start dates of the stored budgets that cannot be read, with rows and sum: no total holds them."""
    table, schema, name = {
        "week": ("budgets", schemas.BUDGETS_WEEK, "dateFrom"),
        "month": ("budgets_month", schemas.BUDGETS_MONTH, "date"),
    }[period]
    lost = w.read(table, schema).where(loose_date(name).isNull())
    return lost.groupBy(name).agg(F.count(F.lit(1)).alias("row_count"), F.sum("budget").alias("total"))


def weekly_report(w: Warehouse, as_of: date) -> DataFrame:
    """Lines of the report on the last full week; tills of no city count in the totals only."""
    online = w.read("online_sales", ONLINE_TABLE)
    sources = revenue_by_source(
        online, _offline(w), w.read("cities", schemas.CITIES), w.read("dates", schemas.DATES)
    )
    day = F.lit((as_of - timedelta(weeks=1)).isoformat()).cast("date")
    week = last_week(week_over_week(sources), calendar_year(day), iso_week(day))
    return report_lines(report_rows(week.where(F.col("sklad").isNotNull())))
