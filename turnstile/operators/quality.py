"""Checks that report and let the run go on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_uniqueness(df: DataFrame, key: Column | str) -> DataFrame:
    """One row: rows, distinct keys, and whether they agree.

    Rows are counted per key first, so that the work on a frequent key is
    done where its rows are.
    """
    key = F.col(key) if isinstance(key, str) else key
    per_key = df.groupBy(key.alias("__key")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count("__key").alias("distinct_keys"),
        F.count(F.when((F.col("n") > 1) & F.col("__key").isNotNull(), 1)).alias("repeated_keys"),
    ).withColumn("is_unique", F.col("total_rows") == F.col("distinct_keys"))


def values_outside(df: DataFrame, column: str, known: Sequence[str], measure: str) -> DataFrame:
    """Values that a fixed list does not hold (null included), with rows and sum."""
    outside = F.col(column).isNull() | ~F.col(column).isin(*known)
    return (
        df.where(outside)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(measure).alias("total"))
    )


def ingest_summary(
    units: DataFrame, unit: str, orders: DataFrame, order_unit: str, rows_of_order: Column
) -> DataFrame:
    """Per source unit: landed orders, rows made of them, and a status.

    Orders are counted as landed, so an order dropped for a bad time still
    counts.  A unit of which nothing landed is an ``error``.
    """
    landed = orders.groupBy(F.col(order_unit).alias("__o")).agg(
        F.count(F.lit(1)).alias("orders_count"), F.sum(rows_of_order).alias("tickets_count")
    )
    counted = units.join(landed, F.col(unit) == F.col("__o"), "left")
    return counted.withColumns(
        {
            "status": F.when(F.col("__o").isNull(), "error").otherwise("success"),
            "orders_count": F.coalesce("orders_count", F.lit(0)),
            "tickets_count": F.coalesce("tickets_count", F.lit(0)),
        }
    ).drop("__o")


def summary_totals(summary: DataFrame) -> DataFrame:
    """Over all units: how many succeeded, how many failed, how many rows."""
    return summary.agg(
        F.count(F.when(F.col("status") == "success", 1)).alias("success_count"),
        F.count(F.when(F.col("status") != "success", 1)).alias("error_count"),
        F.coalesce(F.sum("tickets_count"), F.lit(0)).alias("tickets_count"),
    )
