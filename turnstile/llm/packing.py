"""Best-fit packing of token sequences under several capacities.

A piece takes tokens, one document place and attention cost (its length
squared).  Pieces are placed in order of falling length; the bin is chosen by
all residual capacities together, either where the weighted norm of what would
remain is smallest, or where the weighted dot product of piece and residual is
smallest; a bin that breaks any capacity is no candidate.

Pieces are dealt by a hash into groups of bounded size that are packed each on
its own; a group leaves a few bins open, against thousands filled.  Null and
empty texts are one piece with the end id.  Equal documents and ties are placed
in order of id and piece.  Further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table
from turnstile.llm.token_files import slices, squeezed, unsqueezed
from turnstile.llm.tokens import encode_texts

#: Pieces packed together in one task, about.
PIECES_IN_GROUP = 10_000


class Capacity(NamedTuple):
    tokens: int = 2048
    documents: int = 512
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)  # of tokens, documents and attention in the choice
    rule: str = "norm"  # or "dot"


#: Capacity of the queries: as many documents as tokens, so that tokens alone decide how many sequences there are.
SEQUENCES = Capacity(documents=2048)


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones, the first takes what is left over."""
    rest = n % most
    return ([rest] if rest else []) + [most] * (n // most)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece (any order); no piece may exceed a capacity alone.

    Runs of one length are placed together: as many as there are equally good
    bins, then the next best.  Bins too full for the shortest piece are closed.
    """
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.float64)
    weights = np.array(capacity.weights)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    shortest = int(lengths.min()) if len(lengths) else 0
    left, names, made = np.empty((0, 3)), np.empty(0, dtype=np.int64), 0
    for run in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        n = int(lengths[run[0]])
        need = np.array([n, 1, n * n], dtype=np.float64)
        if (need > limits).any():
            raise ValueError(f"a piece of {n} tokens fits no bin")
        todo = run
        while len(todo):
            fits = np.flatnonzero((left >= need).all(axis=1))
            if len(fits):
                if capacity.rule == "norm":
                    score = (weights * ((left[fits] - need) / limits) ** 2).sum(axis=1)
                else:
                    score = (weights * (left[fits] / limits) * (need / limits)).sum(axis=1)
                # All bins of one score at once; each takes one piece, then scores change.
                chosen = fits[score == score.min()][: len(todo)]
            else:
                each = int(min(capacity.tokens // n, capacity.documents, capacity.attention // (n * n)))
                fresh = max(1, len(todo) // each)
                left = np.vstack([left, np.tile(limits, (fresh, 1))])
                names = np.append(names, np.arange(made, made + fresh))
                chosen = np.arange(len(left) - fresh, len(left))[: len(todo)]
                made += fresh
            placed, todo = todo[: len(chosen)], todo[len(chosen) :]
            bins[placed], offsets[placed] = names[chosen], (capacity.tokens - left[chosen, 0]).astype(np.int64)
            left[chosen] -= need
        open_ = left[:, 0] >= shortest
        if not open_.all():
            left, names = left[open_], names[open_]
    return bins, offsets


def pieces_of(docs: DataFrame, path: str, end_id: int, most: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, squeezed) of the cut texts."""

    def work(batches):
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode_texts(path, batch.column("text").to_pylist(), end_id), strict=True):
                start = 0
                for k, n in enumerate(cut_lengths(len(ids) // 4, most)):
                    own = ids[4 * start : 4 * (start + n)]
                    for column, value in zip(rows, (doc, k, start, n, zlib.crc32(own), squeezed(own) if keep_ids else None), strict=True):
                        column.append(value)
                    start += n
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = document_columns(docs, "doc_id", "text").mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if keep_ids else out.drop("ids")


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; of every column only length, doc_id and piece are looked at."""
    n = pieces.count()
    groups = max(1, math.ceil(n / PIECES_IN_GROUP))
    columns = pieces.columns

    def work(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity)
        return rows[columns].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("_group").applyInPandas(work, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, and which document lies where. A group holds one sequence, of bounded length."""
    place = ("doc_id", "piece", "start", "length", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    laid = packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.aggregate("_parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.transform("_parts", lambda p: p["ids"]).alias("ids"),
        F.transform("_parts", lambda p: F.struct(*[p[c].alias(c) for c in place])).alias("parts"),
    )

    def join_ids(batches):
        for batch in slices(batches):
            ids = [unsqueezed(own).tobytes() for own in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), batch.column("n_tokens"), pa.array(ids, pa.binary()), batch.column("parts")], ["sequence_id", "n_tokens", "ids", "parts"])

    return laid.mapInArrow(join_ids, "sequence_id long, n_tokens long, ids binary, parts array<struct<doc_id long, piece int, start long, length long, offset long>>")


@query("op4_best_fit")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = staged(pieces_of(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0, 2048), "pieces")
    return pack(pieces, SEQUENCES).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
