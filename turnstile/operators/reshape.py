"""Wide to long, long to wide, and nested to flat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.numbers import locale_number


def unpivot_numbers(
    df: DataFrame, service_columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Every column that is no service column becomes rows of (name, value).

    Empty cells and cells that do not read as a number are left out.
    """
    ids = [F.col(f"`{c}`") for c in df.columns if c in service_columns]
    cells = [c for c in df.columns if c not in service_columns]
    if not cells:
        return df.select(*ids, F.lit("").alias(name), F.lit(0.0).alias(value)).limit(0)
    rows = F.array(*[F.struct(F.lit(c).alias(name), locale_number(F.col(f"`{c}`").cast("string")).alias(value)) for c in cells])
    return df.select(*ids, F.inline(rows)).where(F.col(f"`{value}`").isNotNull())


def pivot_sums(
    df: DataFrame, keys: Sequence[Column], on: str, measure: str, columns: Mapping[str, str]
) -> DataFrame:
    """One column per listed value, with the sum of the measure, 0 where there is none.

    Conditional sums: one aggregation and one shuffle, where ``pivot`` takes two
    of each.  A group that holds only unlisted values keeps its row of zeros.
    """
    return df.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(on) == v, F.col(measure)).otherwise(F.lit(0))), F.lit(0))
            .cast("long")
            .alias(name)
            for v, name in columns.items()
        ]
    )


def explode_keeping_childless(df: DataFrame, children: str, child: str) -> DataFrame:
    """One row per element; a row without elements stays once, with a null element."""
    rest = [F.col(c) for c in df.columns if c != children]
    return df.select(*rest, F.explode_outer(children).alias(child))
