"""Tables, staged results and small column helpers shared by the operators."""

from __future__ import annotations

import uuid
from contextvars import ContextVar
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where SQL can express it."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs the rereading of files, not the
    work before them.  ``release`` deletes what a session has staged.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    mine = _STAGED.get()
    if mine is None:
        mine = []
        _STAGED.set(mine)
    mine.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders staged by this thread (each thread has its own context): a run that releases its folders leaves those of a
#: run beside it in another thread alone.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def release(spark: SparkSession) -> None:
    """Delete the folders this thread has staged so far; call it when the results made of them are written."""
    mine = _STAGED.get() or []
    paths, mine[:] = list(mine), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_columns(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns, whatever their names, stay out of the way."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
