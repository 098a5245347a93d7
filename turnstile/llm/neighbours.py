"""Nearest neighbours by cosine: a block matrix join with int8 tiles and exact recomputation.

Vectors are scaled to unit length and rounded to int8 with a scale of their
own.  A tile product of integers gives every cosine of a block of queries and a
block of candidates up to a bound made of the rounding errors' norms.  Pairs
whose upper bound reaches the k-th best lower bound are recomputed in double
precision from the original vectors and kept in heaps of k; heaps of all blocks
are merged by rank.  Nothing is approximate in the result: the bound is proven,
so recall is 1.

Vectors that are null, zero, empty or hold a null, NaN or infinite component
take no part, nor does a null id.  Rows of one id count once (the smallest
vector by component order).  Only vectors of equal length are compared.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table

#: Rows of a block: a task holds one block of candidates and one of queries, and their tile.
CANDIDATES_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 1024
#: Added to every bound for the rounding of double-precision arithmetic.
SLACK = 1e-9


def usable(vectors: DataFrame, key: str, value: str) -> DataFrame:
    """id and doubles of the vectors that take part, one row per id."""
    v = F.transform(F.col(f"`{value}`"), lambda x: x.cast("double"))
    largest = F.array_max(F.transform("v", F.abs))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    rows = document_columns(vectors, key, value).select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    return rows.where(finite & (F.size("v") > 0) & (largest > 0)).groupBy("id").agg(F.min("v").alias("v"))


def quantized(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of what rounding took from the unit vectors."""
    unit = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127.0
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - whole * scale[:, None]
    return whole, scale, np.sqrt((lost * lost).sum(axis=1))


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines in double precision; scaled by the largest component first, so that squares stay finite."""
    q, o = query / np.abs(query).max(), others / np.abs(others).max(axis=1, keepdims=True)
    return (o * q).sum(axis=1) / (np.sqrt((o * o).sum(axis=1)) * np.sqrt((q * q).sum()))


def block_best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, cosine) of the k best of the block for each query, ties to smaller ids."""
    q8, q_scale, q_lost = quantized(queries)
    c8, c_scale, c_lost = quantized(candidates)
    out = []
    for start in range(0, len(query_ids), 128):
        part = slice(start, start + 128)
        # Products of int8 rows are whole numbers; float32 holds them exactly up to 2**24, float64 beyond.
        kind = np.float32 if q8.shape[1] * 127 * 127 < 2**24 else np.float64
        tile = q8[part].astype(kind) @ c8.T.astype(kind)
        near = tile * q_scale[part, None] * c_scale[None, :]
        bound = q_lost[part, None] + (1 + q_lost[part, None]) * c_lost[None, :] + SLACK + (1e-5 if kind == np.float32 else 0)
        low = near - bound
        low[query_ids[part, None] == ids[None, :]] = -np.inf
        reach = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
        survives = (near + bound >= reach[:, None]) & (low > -np.inf)
        for i in range(len(low)):
            chosen = np.flatnonzero(survives[i])
            exact = cosines(queries[start + i], candidates[chosen]) if len(chosen) else []
            best = heapq.nsmallest(k, zip((-np.asarray(exact)).tolist(), ids[chosen].tolist(), strict=True))
            out += [(int(query_ids[start + i]), c, -s) for s, c in best]
    return out


def nearest(vectors: DataFrame, key: str, value: str, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, id and score of the k nearest of each query.

    The grid has one cell per block of candidates and block of queries; both
    kinds of blocks are cut by a hash of the id, so no block is hot.
    """
    rows = staged(usable(vectors, key, value).withColumn("is_query", is_query), "vectors")
    n, m = rows.agg(F.count("*"), F.count_if("is_query")).first()
    across, down = max(1, math.ceil(n / CANDIDATES_IN_BLOCK)), max(1, math.ceil(m / QUERIES_IN_BLOCK))
    a, b = F.pmod(F.xxhash64("id"), F.lit(across)), F.pmod(F.xxhash64("id"), F.lit(down))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = rows.select("id", "v", F.size("v").alias("d"), a.cast("int").alias("a"), every(down).alias("b"))
    queries = rows.where("is_query").select("id", "v", F.size("v").alias("d"), every(across).alias("a"), b.cast("int").alias("b"))

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = block_best(left["id"].to_numpy(), np.stack(left["v"].to_list()), right["id"].to_numpy(), np.stack(right["v"].to_list()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    cells = queries.groupBy("d", "a", "b").cogroup(candidates.groupBy("d", "a", "b")).applyInPandas(work, "query_id long, vec_id long, score double")
    order = [F.col("score").desc(), F.col("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return cells.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op9_block_neighbours")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", F.pmod("id", F.lit(50)) == 0, 5)
