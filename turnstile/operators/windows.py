"""Latest versions, offsets, rolling ratios and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from turnstile.functions.numbers import zero_safe_fraction


def latest_version(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark cuts each map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key with very many versions is no burden.  End the
    order with a unique column.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def partition_max(c: Column | str, keys: Sequence[str]) -> Column:
    """Maximum over the whole partition, on every row of it."""
    return F.max(c).over(Window.partitionBy(*keys))


def offsets(w: WindowSpec, steps: Mapping[str, Sequence[int]], suffix: str = "week") -> dict[str, Column]:
    """``{x_week_1: lag(x, 1), ...}``; by row, not by calendar."""
    return {
        f"{name}_{suffix}_{n}": F.lag(name, n).over(w) for name, lags in steps.items() for n in lags
    }


def rolling_return(
    w: WindowSpec, rows: int, part: str, whole: str, revenue: str, budget: str
) -> Column:
    """(sum part / sum whole) * (sum revenue / sum budget) over the last ``rows`` rows.

    A factor without divisor is 0.  Sums of decimals, so the order of adding
    does not matter.
    """
    frame = w.rowsBetween(1 - rows, Window.currentRow)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).over(frame), F.lit(0))

    return zero_safe_fraction(total(part), total(whole)) * zero_safe_fraction(
        total(revenue), total(budget)
    )


def total_first(label: str, total: str) -> Column:
    return F.when(F.col(label) == total, F.lit(0)).otherwise(F.lit(1))


def rank_total_first(
    df: DataFrame, label: str, value: str, total: str, rank: str, within: Sequence[str] = ()
) -> DataFrame:
    """Row number: the total row, then the value downwards (missing first), then the label.

    For one row per label and ``within`` group.  Without ``within`` the ranking
    is global and runs in one task, so hand it dimension-sized input only.
    """
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    order = [total_first(label, total), F.col(value).desc_nulls_first(), F.col(label)]
    return df.withColumn(rank, F.row_number().over(w.orderBy(*order)).cast("long"))


def up_to_period(period: Sequence[str], limit: Sequence[Column]) -> Column:
    """Row comparison ``(year, week) <= (y, w)``."""
    last = F.struct(*[c.cast("long").alias(p) for p, c in zip(period, limit)])
    return F.struct(*[F.col(p).cast("long").alias(p) for p in period]) <= last
