"""Registration of check queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder, opened on use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def present(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and dates as text, the types both engines print alike."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def check(sql: str | None = None, name: str | None = None):
    """Register a query, by default under its function name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(build(Tables(spark, folder)))

        key = name or build.__name__
        run.__name__ = key
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
