"""Token files: ids ranked by frequency, in byte-aligned code with separate control bytes.

All ids are counted, the most frequent gets rank 0, and ranks are written in
one to four bytes each.  Four two-bit lengths make a control byte; control and
data bytes lie apart, so a reader finds every value's place with one table
lookup per control byte and a running sum.  Documents lie in ascending order of
their id; the files (Parquet as container, one row a document) commit as whole
and can be written again by any executor.

Null ids of documents come first; documents of equal id lie in order of
checksum and length.  Null and empty texts have the end id alone.  Further
columns are ignored.  An empty table gives files without rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table, tasks
from turnstile.llm.tokens import encode_texts
from turnstile.session import shared_folder

#: Lengths in bytes of the four values under each control byte.
LENGTHS = np.array([[(control >> 2 * k & 3) + 1 for k in range(4)] for control in range(256)], dtype=np.uint8)
WEIGHTS = np.array([1, 4, 16, 64], dtype=np.uint8)
DOCUMENT = "part int, doc_id long, first long, n_tokens long, control binary, data binary"
ROWS_AT_ONCE = 64


class TokenFiles(NamedTuple):
    documents: DataFrame  # of DOCUMENT: the files' rows
    by_rank: np.ndarray  # the id of each rank; as long as the vocabulary met


def encode_values(values: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of runs of values; each run is filled with zeros to a multiple of four."""
    padded = -(-counts // 4) * 4
    starts, ends = np.cumsum(padded) - padded, np.cumsum(padded)
    whole = np.zeros(int(padded.sum()), dtype="<u4")
    whole[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(values))] = values
    code = (whole > 0xFF).astype(np.uint8) + (whole > 0xFFFF) + (whole > 0xFFFFFF)
    control = (code.reshape(-1, 4) * WEIGHTS).sum(axis=1, dtype=np.uint8).tobytes()
    used = np.arange(4, dtype=np.uint8) <= code[:, None]
    data = whole.view(np.uint8).reshape(-1, 4)[used].tobytes()
    sizes = np.concatenate(([0], np.cumsum(code.astype(np.int64) + 1)))
    return (
        [control[s // 4 : e // 4] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)],
        [data[s:e] for s, e in zip(sizes[starts].tolist(), sizes[ends].tolist(), strict=True)],
    )


def decode_values(control: list[bytes], data: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The values of the runs, one after the other, without the filling."""
    lengths = LENGTHS[np.frombuffer(b"".join(control), dtype=np.uint8)].ravel()
    stream = np.frombuffer(b"".join(data), dtype=np.uint8)
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    out = stream[at].astype("<u4")
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if not len(longer):
            break
        out[longer] |= stream[at[longer] + k].astype("<u4") << np.uint32(8 * k)
    padded = -(-counts // 4) * 4
    return out[np.repeat(np.cumsum(padded) - padded - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))]


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: what is made of them stays small however many a batch holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def squeezed(ids: bytes) -> bytes:
    """Ids of 4 bytes each, in 2 bytes where all fit (a leading byte tells), compressed."""
    wide = np.frombuffer(ids, dtype="<u4")
    small = not len(wide) or wide.max() < 1 << 16
    return (b"\x02" if small else b"\x04") + zstandard.compress(wide.astype("<u2").tobytes() if small else ids, 1)


def unsqueezed(blobs: list[bytes]) -> np.ndarray:
    if not blobs:
        return np.zeros(0, dtype="<u4")
    read = zstandard.ZstdDecompressor().decompress
    return np.concatenate([np.frombuffer(read(b[1:]), dtype="<u2" if b[0] == 2 else "<u4").astype("<u4") for b in blobs])


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, ids (squeezed), n_tokens and crc32 of each whole text."""

    def work(batches):
        for batch in slices(batches):
            ids = list(encode_texts(path, batch.column("text").to_pylist(), end_id))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(squeezed, ids)), pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                ["doc_id", "ids", "n_tokens", "ids_crc32"],
            )

    return document_columns(docs, "doc_id", "text").mapInArrow(work, "doc_id long, ids binary, n_tokens long, ids_crc32 long")


def ranked_ids(tokens: DataFrame) -> np.ndarray:
    """All ids met, the most frequent first, ties by id.

    Each task sends one row per id at most, and the driver gets one per id: both
    are bounded by the tokenizer's vocabulary, not by the documents.
    """

    def count(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in slices(batches, 1024):
            found = np.bincount(unsqueezed(batch.column("ids").to_pylist()))
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = counts.sort_values(["n", "id"], ascending=[False, True])
    return counts["id"].to_numpy(dtype="<u4")


def write_token_files(docs: DataFrame, path: str, end_id: int, target: str) -> TokenFiles:
    """Tokenize, rank and write all documents under ``target``; the rank table lies beside them."""
    spark = docs.sparkSession
    tokens = staged(tokenized(docs, path, end_id), "ids")
    by_rank = ranked_ids(tokens)
    shared = spark.sparkContext.broadcast(by_rank)

    def encode(batches):
        by_rank = shared.value
        rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype="<u4")
        rank[by_rank] = np.arange(len(by_rank), dtype="<u4")
        part, first = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            counts = batch.column("n_tokens").to_numpy()
            control, data = encode_values(rank[unsqueezed(batch.column("ids").to_pylist())], counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(counts), pa.int32()),
                    batch.column("doc_id"),
                    pa.array(first + np.cumsum(counts) - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(control, pa.binary()),
                    pa.array(data, pa.binary()),
                ],
                ["part", "doc_id", "first", "n_tokens", "control", "data"],
            )
            first += int(counts.sum())

    ordered = tokens.repartitionByRange(tasks(spark), "doc_id", "ids_crc32", "n_tokens").sortWithinPartitions("doc_id", "ids_crc32", "n_tokens")
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(encode, DOCUMENT).write.option("compression", "zstd").parquet(f"{target}/documents")
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(by_rank.tolist())], "rank int, id long").coalesce(1).write.parquet(f"{target}/ranks")
    return read_token_files(spark, target)


def read_token_files(spark: SparkSession, target: str) -> TokenFiles:
    ranks = spark.read.parquet(f"{target}/ranks").toPandas().sort_values("rank")
    return TokenFiles(spark.read.schema(DOCUMENT).parquet(f"{target}/documents"), ranks["id"].to_numpy(dtype="<u4"))


def decoded(files: TokenFiles) -> DataFrame:
    """part, doc_id, first, n_tokens and the ids (little-endian, 4 bytes each) read from the files."""
    shared = files.documents.sparkSession.sparkContext.broadcast(files.by_rank)

    def decode(batches):
        for batch in slices(batches):
            counts = batch.column("n_tokens").to_numpy()
            ids = shared.value[decode_values(batch.column("control").to_pylist(), batch.column("data").to_pylist(), counts)].tobytes()
            ends = 4 * np.cumsum(counts)
            own = [ids[e - 4 * n : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "doc_id", "first", "n_tokens")), pa.array(own, pa.binary())], ["part", "doc_id", "first", "n_tokens", "ids"])

    return files.documents.mapInArrow(decode, "part int, doc_id long, first long, n_tokens long, ids binary")


def with_starts(documents: DataFrame, sums_of: DataFrame) -> DataFrame:
    """``start``: tokens of all documents before; one sum per file goes through the driver."""
    before, starts = 0, []
    for part, n in sorted((r[0], r[1]) for r in sums_of.groupBy("part").agg(F.sum("n_tokens")).collect()):
        starts.append((part, before))
        before += n
    offsets = documents.sparkSession.createDataFrame(starts, "part int, before long")
    return documents.join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.col("first")).drop("before")


@query("op3_ranked_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    target = f"{shared_folder(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    files = write_token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, target)
    read = decoded(files).select("part", "doc_id", "first", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return with_starts(read, files.documents).select("doc_id", "start", "n_tokens", "ids_crc32")
