"""N-gram Jaccard join by MinHash banding: near copies and how many each text has.

Every text becomes the set of its five-word shingles; texts of equal sets are
one class and go on as one row.  Minimum hashes are taken in bands, classes
that share a band's value meet, and each meeting pair is verified on the full
shingle sets.  ``bands_for`` chooses the bands so that a pair of the wanted
similarity meets with the wanted probability.

Few classes under one value are paired outright; many are dealt into blocks
and compared block against block, where only counts and a spanning tree of the
links leave the task, so that no group is gathered and its pairs are not
emitted.  A pair is verified once, under the first value it shares.

Null texts and texts without words have no shingles: they form one class
without links.  Texts of fewer than five words are one shingle.  Null and
repeated ids are kept row by row.  Classes are told apart by 64-bit hashes of
their sets.  Further columns are ignored by ``linked``.  An empty table gives
no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table
from turnstile.llm.graph import components
from turnstile.llm.token_files import slices
from turnstile.llm.words import mixed, shingles

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.9995
#: Classes under one value that are paired outright, and of one block otherwise.
FEW, BLOCK = 8, 128
#: Minimum hashes are taken over so many shingles at a time, which stay in the processor's cache.
AT_ONCE = 256


class Bands(NamedTuple):
    bands: int
    rows: int


def bands_for(similarity: float, recall: float, rows: int = 7) -> Bands:
    """As few bands of ``rows`` hashes as let a pair of that similarity share one with that probability."""
    return Bands(math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)), rows)


def band_values(found: np.ndarray, bands: Bands) -> np.ndarray:
    """One 64-bit value per band of a shingle set, different between bands."""
    n = bands.bands * bands.rows
    keys = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), AT_ONCE):  # multiplying by odd numbers and adding permutes; the high bits decide
        x = found[start : start + AT_ONCE, None]
        least = np.minimum(least, (x * (keys | np.uint64(1)) + keys).min(axis=0))
    out = np.zeros(bands.bands, dtype=np.uint64)
    for row in least.reshape(bands.bands, bands.rows).T:
        out = mixed(out ^ row) + row
    return mixed(out + np.arange(bands.bands, dtype=np.uint64))


def row_key() -> Column:
    """One number for id and text together: nulls allowed, equal for repeated rows alone."""
    return F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())


def sketched(docs: DataFrame, bands: Bands) -> DataFrame:
    """doc_id, row_key, set_id, n_shingles and the band values of each document."""

    def work(batches):
        for batch in slices(batches):
            ids, sizes, values = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, SHINGLE)
                ids.append(xxhash.xxh64_intdigest(found.tobytes()) - 2**63)
                sizes.append(len(found))
                values.append(band_values(found, bands).view(np.int64) if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(values, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "set_id", "n_shingles", "bands"],
            )

    rows = document_columns(docs, "doc_id", "text").select("doc_id", row_key().alias("row_key"), "text")
    return rows.mapInArrow(work, "doc_id long, row_key long, set_id long, n_shingles long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id, crowds, bands and shingles (8 bytes each) of the classes in ``wanted``, made anew from one text of each."""

    def work(batches):
        for batch in slices(batches):
            found = [shingles(text, SHINGLE).tobytes() for text in batch.column("text").to_pylist()]
            kept = [batch.column(c) for c in ("set_id", "crowds", "bands")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], ["set_id", "crowds", "bands", "shingles"])

    texts = document_columns(docs, "doc_id", "text").select(row_key().alias("row_key"), "text")
    picked = texts.join(wanted, "row_key").dropDuplicates(["row_key"])
    return picked.select("set_id", "crowds", "bands", "text").mapInArrow(work, "set_id long, crowds array<long>, bands array<long>, shingles binary")


def _similar_pairs(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of which sets have at least that Jaccard similarity: products of indicator matrices over shared shingles."""
    sizes = np.array([len(s) for s in sets])
    shared, n = np.zeros((len(sets), len(sets)), dtype=np.float32), len(sets)
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    values = values[counts > 1]
    owner = np.repeat(np.arange(n), sizes)
    at = np.searchsorted(values, whole := np.concatenate(sets))
    at[at == len(values)] = 0
    hit = values[at] == whole if len(values) else np.zeros(len(whole), dtype=bool)
    owner, at = owner[hit], at[hit]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for start in range(0, len(values), 8192):
        lo, hi = np.searchsorted(at, [start, start + 8192])
        part = np.zeros((n, min(8192, len(values) - start)), dtype=np.float32)
        part[owner[lo:hi], at[lo:hi] - start] = 1
        shared += part @ part.T
    union = sizes[:, None] + sizes[None, :] - shared
    return shared >= similarity * union - 1e-6


def compare_blocks(rows: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links within a cell, summed up: per class the number of links first met here, and the label of its links.

    A cell holds one block or two of one value.  A pair counts where its band is the first
    of all that it shares.
    """
    rows = rows.drop_duplicates("set_id").sort_values("set_id")
    ids, block, band = rows["set_id"].to_numpy(), rows["block"].to_numpy(), int(rows["band"].iloc[0])
    bands = np.stack(rows["bands"].to_list())
    counted = np.ones((len(ids), len(ids)), dtype=bool)
    for own in bands[:, :band].T:
        counted &= own[:, None] != own[None, :]
    if rows["left"].iloc[0] != rows["right"].iloc[0]:
        counted &= block[:, None] != block[None, :]
    np.fill_diagonal(counted, False)
    open_ = np.flatnonzero(counted.any(axis=1))  # pairs met under an earlier value need no comparing again
    ids, counted = ids[open_], counted[np.ix_(open_, open_)]
    if len(ids):
        counted &= _similar_pairs([np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"].iloc[open_]], similarity)
    label = np.arange(len(ids))
    while len(ids):  # smallest label over links, until nothing changes
        lower = np.minimum(label, np.where(counted, label[None, :], len(ids)).min(axis=1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    links = counted.sum(axis=1)
    return pd.DataFrame({"a": ids, "b": ids[label], "links": links})[links > 0]


def classified(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, row_key, set_id, root and n_links of every document; equal roots are linked over any number of steps."""
    rows = staged(sketched(docs, bands_for(similarity, recall)), "sketches")
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(F.min("row_key").alias("row_key"), F.first("bands").alias("bands"))
    classes = staged(classes, "classes")
    met = classes.select("set_id", F.posexplode("bands").alias("band", "value"))
    shared = met.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(met.join(shared, "value"), "members")
    wanted = members.groupBy("set_id").agg(F.collect_set(F.when(F.col("n") > FEW, F.col("value"))).alias("crowds"))  # at most one per band
    # Values that are no crowd's become unlike any other's, so that only crowds are compared between bands.
    crowded_bands = F.transform("bands", lambda x, i: F.when(F.array_contains("crowds", x), x).otherwise(F.xxhash64("set_id", i)))
    wanted = wanted.join(classes, "set_id").select("set_id", "row_key", "crowds", F.when(F.size("crowds") > 0, crowded_bands).alias("bands"))
    sets = staged(_sets(docs, wanted), "sets")

    # Few under one value: outright pairs, each once, unless the pair also meets in a crowd.
    few = members.where(F.col("n") <= FEW).groupBy("value").agg(F.collect_set("set_id").alias("s"))
    pairs = few.select(F.explode(F.expr("flatten(transform(s, x -> transform(filter(s, y -> y > x), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b").distinct()
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa"), F.col("crowds").alias("ca"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb"), F.col("crowds").alias("cb"))
    facing = pairs.join(left, "a").join(right, "b").where(~F.arrays_overlap("ca", "cb")).select("a", "b", "sa", "sb")

    def verify(batches):
        for batch in slices(batches, 256):
            a, b = ([np.frombuffer(s, dtype=np.uint64) for s in batch.column(c).to_pylist()] for c in ("sa", "sb"))
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)])
            union = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)]) - both
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(both >= similarity * union - 1e-6))

    plain = facing.mapInArrow(verify, "a long, b long")

    # Many under one value: blocks by a hash, one cell per pair of blocks.
    many = members.where(F.col("n") > FEW).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    cells = many.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select("value", "band", "set_id", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    filled = cells.join(sets.drop("crowds"), "set_id")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(rows, similarity)

    crowded = filled.groupBy("value", "left", "right").applyInPandas(compare, "a long, b long, links long")
    both_ways = plain.select("a", "b", F.lit(1).cast("long").alias("links")).unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(1).cast("long").alias("links")))
    links = staged(both_ways.unionByName(crowded), "links")
    counts = links.groupBy("a").agg(F.sum("links").alias("n_links")).withColumnRenamed("a", "set_id")
    reached = components(links.select("a", "b")).select(F.col("node").alias("set_id"), "root")
    out = rows.select("doc_id", "row_key", "set_id").join(counts, "set_id", "left").join(reached, "set_id", "left")
    return staged(out.withColumn("root", F.coalesce("root", "set_id")).withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))), "classified")


def linked(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, text_id and n_links of every document.

    ``class_id``: smallest doc_id among all texts reached over links; ``text_id``: smallest among texts of equal
    shingles; ``n_links``: number of other classes of equal shingles with at least that similarity.
    """
    out = classified(docs, similarity, recall)
    # Stored first: joined to a stored side, a class of very many documents can be split over tasks.
    firsts = staged(out.groupBy("root").agg(F.min("doc_id").alias("class_id")), "firsts")
    texts = staged(out.groupBy("set_id").agg(F.min("doc_id").alias("text_id")), "texts")
    return out.join(firsts, "root").join(texts, "set_id").select("doc_id", "class_id", "text_id", "n_links")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The documents (all columns) with one left of each class: that of the smallest doc_id, null first; repeated rows count once."""
    out = classified(docs, similarity, recall)
    kept = out.groupBy("root").agg(F.min(F.struct("doc_id", "row_key")).alias("first")).select(F.col("first.row_key").alias("__row_key"))
    return docs.withColumn("__row_key", row_key()).join(kept, "__row_key").dropDuplicates(["__row_key"]).drop("__row_key")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_\x{80}-\x{10FFFF}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
sets AS (SELECT doc_id, list_sort(list(g)) AS k FROM s GROUP BY doc_id),
c AS (SELECT k, min(doc_id) AS t, len(k) AS n FROM sets GROUP BY k),
m AS (SELECT s.* FROM s JOIN c ON s.doc_id = c.t),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM m x JOIN m y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN c ca ON a = ca.t JOIN c cb ON b = cb.t WHERE p.n >= 0.8 * (ca.n + cb.n - p.n) - 1e-6),
r AS (SELECT t AS a, t AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
l AS (SELECT a, min(b) AS class_id FROM r GROUP BY a),
nolinks AS (SELECT min(doc_id) AS t FROM w WHERE len(w) = 0)
SELECT doc_id, coalesce(l.class_id, (SELECT t FROM nolinks)) AS class_id, coalesce(c.t, (SELECT t FROM nolinks)) AS text_id,
  (SELECT count(*) FROM e WHERE e.a = c.t) AS n_links
FROM w LEFT JOIN sets USING (doc_id) LEFT JOIN c ON sets.k = c.k LEFT JOIN l ON l.a = c.t
"""


@query("op8_ngram_join", SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return linked(table(spark, folder, "documents"))
