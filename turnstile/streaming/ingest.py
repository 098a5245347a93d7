"""Incremental folder ingest: new files only, written once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from turnstile.sources.landed import Landing, lines_with_place
from turnstile.sources.tables import handed_over_within, write_absent


def ingest_new_files(
    spark: SparkSession,
    source: DataFrame,
    shape: Callable[[DataFrame], DataFrame | Landing],
    path: str,
    schema: StructType,
    keys: Sequence[str],
    first: Sequence[Column],
    checkpoint: str,
    partition: str | None = None,
    reject: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Take what a streaming file source has not delivered yet and stop.

    ``source`` is ``spark.readStream...`` over the landing folder.  The file
    checkpoint replaces reading the folder again.  A micro-batch inserts only
    keys the table lacks, so one that is repeated after a failure changes
    nothing.  What ``shape`` rejects goes to ``reject``: the checkpoint counts
    the file as read, so after correction it is landed under a new name or
    loaded from its folder.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        # What a micro-batch hands over to itself (rejects, headings, the batch) is deleted when it is written.
        with handed_over_within(batch.sparkSession):
            shaped = shape(batch)
            rows, rejects = shaped if isinstance(shaped, Landing) else (shaped, None)
            if reject is not None and rejects is not None:
                reject(rejects)
            write_absent(batch.sparkSession, path, schema, rows, keys, first, partition)

    return (
        source.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def landing_stream(spark: SparkSession, folder: str, glob: str, **options) -> DataFrame:
    """Stream of the lines of a landing folder of CSV files, with the place of each.

    A file is never spread over two micro-batches.
    """
    return lines_with_place(spark.readStream.option("pathGlobFilter", glob).options(**options).text(folder))


def parquet_stream(spark: SparkSession, folder: str, schema: StructType, glob: str, **options) -> DataFrame:
    """Stream of a landing folder of Parquet files."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .options(**options)
        .parquet(folder)
    )
