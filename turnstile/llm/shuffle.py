"""Reproducible shuffle of rows into shards: a keyed permutation of global row numbers.

Rows are numbered once in key order.  A Feistel network over pairs
(number div b, number mod b), with cycle walking down to the count of rows,
permutes the numbers; the place in the permutation gives shard and slot.
Shard sizes differ by one row at most, and any row's place can be computed
from its number, the count and the seed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table, tasks, whole_text
from turnstile.llm.feistel import on_pairs

ROUNDS = 6
SHARDS = 40
#: Steps of cycle walking tried in the expression. At most isqrt(n) numbers lie beyond n, so this is
#: proven to end for n up to 4096 and fails with probability n ** -32 beyond (then the query raises).
STEPS = 64


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Rows with their global number from 0 in the given order (nulls first).

    Range partitions are sorted, numbered within, and offset by the counts of
    the partitions before: no task sees more than its range.  Equal rows of a
    hot key are parted by the further columns and at last at random, which no
    result can show.
    """
    spark = df.sparkSession
    spread = [F.col(f"`{c}`") for c in order] + [F.rand(7)]
    ranged = df.repartitionByRange(tasks(spark), *spread).sortWithinPartitions(*[F.col(f"`{c}`") for c in order])
    local = staged(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, within = F.shiftrightunsigned("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    local = local.withColumn("_part", part.cast("int")).withColumn("_within", within)
    # One row per partition.
    counts = [(r[0], r[1]) for r in local.groupBy("_part").agg(F.max("_within") + 1).collect()]
    before, offsets = 0, []
    for p, n in sorted(counts):
        offsets.append((p, before))
        before += n
    starts = spark.createDataFrame(offsets, "_part int, _before long")
    return local.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_within")).drop("_part", "_within", "_before", "_place")


def permuted(number: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The place of ``number`` (0 to n - 1) in a permutation fixed by ``seed`` and ``n``."""
    if n <= 1:
        return number
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def network(x: Column) -> Column:
        return on_pairs(x, a, b, rounds, lambda other, r: F.xxhash64(other, F.lit(seed), r))

    once = network(number)
    inside = F.lit(n)
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(STEPS)), once, lambda x, _: F.when(x < inside, x).otherwise(network(x)))
    return F.when(once < inside, once).when(walked < inside, walked).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))


def place_rows(df: DataFrame, order: list[str], shards: int, seed: int) -> DataFrame:
    """Rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``order`` must tell rows apart for the placing to be reproducible; rows
    equal in all of it may exchange places.  Null keys come first.  An empty
    table gives no rows.
    """
    rows = numbered(df, order)
    n = rows.count()
    place = permuted(F.col("row_number"), n, seed)
    return (
        rows.withColumn("_at", place)
        .withColumn("shard", F.pmod("_at", F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("_at") / F.lit(shards)).cast("long"))
        .drop("_at")
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    placed.repartition(F.col("shard")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@query("op7_feistel_shards")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_columns(table(spark, folder, "documents"), "doc_id", "text")
    rows = docs.select("doc_id", (F.octet_length(whole_text()) + 16).cast("long").alias("size"), F.crc32(F.encode(whole_text(), "UTF-8")).alias("text_crc32"))
    placed = place_rows(rows, ["doc_id", "text_crc32", "size"], SHARDS, seed=20240607)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")
