"""Tables as Parquet folders: scan, append, replace, insert-if-absent, upsert.

No transactional table format is assumed.  Keyed writes stay repeatable instead:
giving the same batch twice leaves the same table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from turnstile.functions.keys import packed_text
from turnstile.operators.windows import latest_version
from turnstile.session import shared_folder


#: Sub-folder of a table that holds its pointers: empty files named ``<nanoseconds>.<version folder>``; the newest names the rows.
VERSIONS = "_versions"


#: Compression of rows appended to a table or handed over: key digests are hex text, which only an entropy coder shortens.
STORED = "zstd"


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds a table's rows: the version its newest pointer names, or the table's own folder.

    Two small calls on the file system, by the driver.
    """
    path = path.rstrip("/")
    files, place = _place(spark, f"{path}/{VERSIONS}")
    if not files.exists(place):
        return path
    names = sorted(str(s.getPath().getName()) for s in files.listStatus(place))
    return f"{path}/{names[-1].split('.', 1)[1]}" if names else path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table or saved view; with a schema, an absent one is empty."""
    path = current_folder(spark, path)
    if schema is None:
        return spark.read.parquet(path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def spread_if_few(df: DataFrame) -> DataFrame:
    """Rows over all cores where the source has fewer splits than there are cores.

    For row-wise work that costs far more than moving the rows.  A source of
    many files or row groups keeps its splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """Store a result in the cluster's shared folder and go on from the stored table.

    For a result used more than once: it is computed once, its size is known to
    the planner, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    run = _HANDED_OVER.get()
    if run is not None:
        run.append(path)
    df.write.option("compression", STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The folders handed over within the innermost ``handed_over_within`` of this thread (or task of asyncio); runs side
#: by side in threads keep their own lists, so one that ends deletes nothing another still reads.
_HANDED_OVER: ContextVar[list[str] | None] = ContextVar("handed_over", default=None)


@contextmanager
def handed_over_within(spark: SparkSession) -> Iterator[None]:
    """Delete what was handed over within, also after a failure; nothing lazy may go on reading it."""
    paths: list[str] = []
    token = _HANDED_OVER.set(paths)
    try:
        yield
    finally:
        _HANDED_OVER.reset(token)
        for path in paths:
            _delete(spark, path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def delete_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete the folders (partitions of a table) that exist; absent ones are passed over."""
    for path in paths:
        _delete(spark, path)


def hand_over_all(frames: Mapping[str, DataFrame]) -> list[DataFrame]:
    """``hand_over`` of independent results side by side, so one's last tasks leave no core idle."""
    # Each thread writes in a copy of the caller's context, so its folders join the caller's run.
    calls = [(copy_context(), name, df) for name, df in frames.items()]
    with ThreadPoolExecutor(max_workers=max(len(frames), 1)) as pool:
        return list(pool.map(lambda call: call[0].run(hand_over, call[2], call[1]), calls))


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").option("compression", STORED).partitionBy(*partition_by).parquet(current_folder(df.sparkSession, path))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write the new rows into a version folder of their own, then point the table at it; readers see the old or the new table whole.

    Nothing is renamed (on an object store a rename is a copy): a pointer, an
    empty file whose name orders it and names the folder, is created when all
    rows are written.  A failed write leaves the old pointer and deletes its
    folder.  The version before stays for readers that resolved it just
    before the switch; older ones and rows of a table that had no pointers yet
    are deleted afterwards.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = current_folder(spark, path)
    folder = f"v-{uuid.uuid4().hex}"
    try:
        (df.hint("rebalance", *partition_by) if partition_by else df).write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    except Exception:
        _delete(spark, f"{path}/{folder}")
        raise
    files, pointer = _place(spark, f"{path}/{VERSIONS}/{time.time_ns():020d}.{folder}")
    files.create(pointer, False).close()
    kept = {VERSIONS, folder, before.rsplit("/", 1)[1] if before != path else folder}
    for status in files.listStatus(_place(spark, path)[1]):
        if str(status.getPath().getName()) not in kept:
            files.delete(status.getPath(), True)
    pointers = sorted(files.listStatus(_place(spark, f"{path}/{VERSIONS}")[1]), key=lambda st: str(st.getPath().getName()))
    for status in pointers:
        if str(status.getPath().getName()).split(".", 1)[1] not in kept:
            files.delete(status.getPath(), False)


def replace_periods(df: DataFrame, path: str, period: Sequence[str]) -> None:
    """Replace only the periods the frame holds; a rerun does not duplicate them.

    Rows are brought together by period so that folders get few files; a period
    that holds a large part of all rows is split over several tasks.
    """
    (
        df.hint("rebalance", *period)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*period)
        .parquet(current_folder(df.sparkSession, path))
    )


def one_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return latest_version(batch, keys, order)


#: Repeated keys up to which the rows without one are left where they are.
FEW_KEYS = 500_000


def first_where_repeated(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``one_per_key`` of a batch whose keys seldom repeat: only rows of repeated keys are moved and ranked.

    Keys are counted by a 64-bit hash; two keys of one hash only cost their rows
    the ranking.  A batch of many repeated keys is ranked as a whole.
    """
    marked = batch.withColumn("__hash", F.xxhash64(*[F.col(k) for k in keys]))
    counts = marked.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"))
    repeated = hand_over(counts.where("__n > 1").select("__hash"), "repeated-keys")
    found = repeated.limit(FEW_KEYS + 1).count()
    if found == 0:
        return batch
    if found > FEW_KEYS:
        return one_per_key(batch, keys, order)
    ranked = one_per_key(marked.join(repeated, "__hash", "left_semi"), keys, order)
    return marked.join(repeated, "__hash", "left_anti").unionByName(ranked).drop("__hash")


def _packed(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Key columns to be compared alone, texts in bytes."""
    return [(packed_text(k) if df.schema[k].dataType == StringType() else F.col(k)).alias(f"__{k}") for k in keys]


def absent_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], first: Sequence[Column]
) -> DataFrame:
    """The rows of a batch an insert-if-absent would add: the first per new key.

    Only the key columns of the target are read.
    """
    wanted = one_per_key(batch, keys, first)
    return wanted.join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], first: Sequence[Column]
) -> DataFrame:
    """The target after inserting what it lacks; the first write of a key stays."""
    return target.unionByName(absent_rows(target, batch, keys, first).select(*target.columns))


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], newest: Sequence[Column]
) -> DataFrame:
    """The target after updating known keys and inserting new ones; the batch wins.

    Target rows that keep their values are anti-joined away from the batch
    keys, so a large target against a small batch is neither sorted nor ranked.
    """
    wanted = one_per_key(batch, keys, newest)
    kept = target.join(wanted.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(wanted.select(*target.columns))


#: Distinct partitions of a batch that are listed one by one; more are given as a range.
LISTED_PARTITIONS = 2000


def _touched(target: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The target's partitions that may hold the batch's: a filter on the partition column, so other folders are not read.

    Of a batch with very many partitions all between its first and last are taken.
    """
    values = [r[0] for r in batch.select(partition).distinct().limit(LISTED_PARTITIONS + 1).collect()]
    own = F.col(partition)
    if len(values) <= LISTED_PARTITIONS:
        listed = own.isin([v for v in values if v is not None])
        return target.where(listed | own.isNull() if None in values else listed)
    lo, hi = (batch.agg(f(partition)).scalar() for f in (F.min, F.max))
    return target.where(own.between(lo, hi) | own.isNull())


def write_absent(
    spark: SparkSession,
    path: str,
    schema: StructType,
    batch: DataFrame,
    keys: Sequence[str],
    first: Sequence[Column],
    partition: str | None = None,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Append what the stored table lacks.

    With a ``partition`` column, which a key must determine, the table is
    partitioned by it and only the batch's range of partitions is looked at.
    Then the batch is read again in every step rather than stored: keys are
    compared alone, and rows are moved once, the new ones, to their partition.
    ``derived`` columns follow from the others and are made anew after the move.
    """
    target = read_table(spark, path, schema)
    if partition is None:
        append_table(absent_rows(target, batch, keys, first).select(*schema.names), path)
        return
    rows = batch.select(*schema.names)
    if not target.isEmpty():
        held = _touched(target, hand_over(rows.select(partition).distinct(), "batch-partitions"), partition)
        missing = rows.select(*_packed(rows, keys)).join(held.select(*_packed(held, keys)), [f"__{k}" for k in keys], "left_anti")
        missing = hand_over(missing.distinct(), "missing-keys")
        if missing.isEmpty():
            return
        rows = rows.select("*", *_packed(rows, keys))
        same = reduce(lambda a, b: a & b, [rows[f"__{k}"].eqNullSafe(missing[f"__{k}"]) for k in keys])
        rows = rows.join(missing, same, "left_semi").select(*schema.names)
    derived = dict(derived or {})
    new = first_where_repeated(rows, keys, first).drop(*derived).hint("rebalance", partition)
    append_table(new.withColumns(derived).select(*schema.names) if derived else new, path, [partition])


def write_upsert(
    spark: SparkSession,
    path: str,
    schema: StructType,
    batch: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column],
    partition: str,
    version: str | None = None,
) -> None:
    """Upsert into a stored table, rewriting only the partitions the batch touches.

    A key must always lie in the same partition.  The batch is stored once, one
    row per key, as it is used several times.  The batch wins, or with a
    ``version`` column the row of the highest version, so that an older batch
    that comes late overwrites nothing.  The merged rows are written once: they
    take the place of the old partitions when all tasks have ended.
    """
    wanted = hand_over(one_per_key(batch, keys, newest).select(*schema.names), "batch")
    target = _touched(read_table(spark, path, schema), wanted, partition)
    held = wanted.select(F.col(partition).alias("__held")).distinct()
    touched = target.join(held, F.col(partition).eqNullSafe(F.col("__held")), "left_semi").select(*schema.names)
    if version is None:
        merged = touched.join(wanted.select(*keys), list(keys), "left_anti").select(*schema.names).unionByName(wanted)
    else:
        both = touched.withColumn("__late", F.lit(0)).unionByName(wanted.withColumn("__late", F.lit(1)))
        merged = one_per_key(both, keys, [F.col(version).desc_nulls_last(), F.col("__late").desc()]).drop("__late")
    replace_periods(merged, path, [partition])


#: Folders of a keyed table: a key's folder is a hash of the key, so a batch touches at most this many, however many days it spans.
KEY_BUCKETS = 64
BUCKET = "key_bucket"


def key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_BUCKETS)).cast("int")


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    found = []
    for path in paths:
        files, place = _place(spark, path)
        if files.exists(place):
            found.append(path)
    return found


def write_keyed_upsert(
    spark: SparkSession,
    path: str,
    schema: StructType,
    batch: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column],
    version: str | None = None,
    order: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Upsert into a table kept in ``KEY_BUCKETS`` folders by a hash of the key, rewriting only the files that hold a batch key.

    The batch (one row per key, as in ``write_upsert``) names its folders; these
    are read by path, so the table is never listed whole.  Of their files those
    holding a key of the batch are found by a join of keys and versions alone;
    a batch of which no row is newer than the stored one ends there.  Else the
    files are read whole and merged with the batch in one move, by folder, and
    the merged rows are appended as new files; the files they replace are
    deleted afterwards.  Untouched files are neither read beyond their keys nor
    written.  Rows are sorted by ``order`` within the new files, so that filters
    on it skip row groups.  ``derived`` columns follow from the others and are
    made anew after the move.  The batch is read again in every step.

    A run that fails between the append and the deletes leaves both versions of
    the touched keys; running the same batch again finds and replaces both.
    """
    path, derived = current_folder(spark, path), dict(derived or {})
    stored_schema = StructType([*schema.fields, StructField(BUCKET, IntegerType(), True)])
    rows = batch.select(*schema.names).withColumn(BUCKET, key_bucket(keys))
    # At most KEY_BUCKETS rows.
    buckets = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
    folders = _existing(spark, [f"{path}/{BUCKET}={b}" for b in buckets])
    old: list[str] = []
    if folders:
        stored = spark.read.schema(stored_schema).option("basePath", path).parquet(*folders)
        versions = [F.col(version)] if version else []
        held = stored.select(*_packed(stored, keys), F.input_file_name().alias("__file"), *[v.alias("__held") for v in versions])
        mine = rows.select(*_packed(rows, keys), *[v.alias("__new") for v in versions])
        newer = F.col("__held").isNull() | F.coalesce(F.col("__new") >= F.col("__held"), F.lit(False)) if version else F.lit(True)
        # One row per file of the touched folders, and one for the new keys.
        met = mine.join(held, [f"__{k}" for k in keys], "left").groupBy("__file").agg(F.max(newer).alias("newer")).collect()
        if not any(r["newer"] for r in met):
            return
        old = [r["__file"] for r in met if r["__file"] is not None]
    merged = first_where_repeated(rows, keys, newest)
    if old:
        touched = spark.read.schema(stored_schema).option("basePath", path).parquet(*old).select(*stored_schema.names)
        if version is None:
            merged = touched.join(rows.select(*keys), list(keys), "left_anti").unionByName(merged)
        else:
            merged = touched.withColumn("__late", F.lit(0)).unionByName(merged.withColumn("__late", F.lit(1)))
    out = merged.drop(*derived).repartition(BUCKET)
    out = out.withColumns(derived) if derived else out
    if old and version is not None:
        out = one_per_key(out, [BUCKET, *keys], [F.col(version).desc_nulls_last(), F.col("__late").desc()])
    out = out.select(*stored_schema.names)
    out = out.sortWithinPartitions(BUCKET, *order) if order else out
    out.write.mode("append").option("compression", STORED).partitionBy(BUCKET).parquet(path)
    for file in old:
        _delete(spark, file)
