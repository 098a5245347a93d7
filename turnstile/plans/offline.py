"""Receipts to offline sales of a city."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.constants import TILL_TO_CITY
from turnstile.functions.labels import decode


def offline_sales(
    receipts: DataFrame, day: date | None = None, tills: Mapping[str, str] = TILL_TO_CITY
) -> DataFrame:
    """Receipts (of one day) with the city of their till; an unknown till has none.

    The day is a half-open range on the stored time, which reaches the scan.
    """
    if day is not None:
        start = F.lit(day.isoformat()).cast("timestamp_ntz")
        receipts = receipts.where(
            (F.col("sale_date") >= start) & (F.col("sale_date") < start + F.expr("INTERVAL 1 DAY"))
        )
    return receipts.select(
        F.col("sale_date").alias("sale_ts"),
        F.lit("").alias("buyer"),
        "item_category",
        "item",
        F.lit("").alias("unit"),
        "qty",
        F.col("amount").alias("revenue"),
        decode("kkm", tills).alias("city"),
        "load_dttm",
    )
