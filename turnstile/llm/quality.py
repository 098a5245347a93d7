"""Quality classifier: naive Bayes features under a linear support vector machine.

A text's features are indicators: its words, its word shapes (letters as ``a``
or ``A``, digits as ``0``, the rest as it stands) alone and in pairs, and how
large a part of the text a shape, or repetition of the word before, makes.
Each indicator is scaled by the log ratio of its frequency in good and bad
texts, then a hinge-loss model is fitted by dual coordinate descent, and its
margin is mapped to a probability on rows left out of the fit.

The model is fitted on at most ``TRAINING_ROWS`` labelled texts, chosen by a
hash of their id, in one task; every text is scored as a whole.  Null and empty
texts have no features and get the score of the intercept.  Labels repeated
alike count once, contradicting ones not at all; a null id has no label.
Without labels of both kinds every score is one half.  Further columns are
ignored by ``scored`` and kept by ``accepted``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table
from turnstile.llm.token_files import slices

#: Features are hashed to so many places, which bounds the model.
PLACES = 1 << 18
TRAINING_ROWS = 12_000
#: Every so many training rows, one sets the probabilities instead of the fit.
CALIBRATION = 5
COST, SWEEPS, SMOOTHING = 0.1, 20, 1.0
ACCEPTED = 0.3
#: Parts of a text above which a shape's share is an indicator of its own.
SHARES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)

_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")


def features(text: str | None) -> np.ndarray:
    """Sorted places of the indicators that hold for the text."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    own = text.split()
    shapes = _DIGIT.sub("0", _UPPER.sub("A", _LOWER.sub("a", text))).split()
    n = max(1, len(own))
    found = {"w" + w for w in set(text.lower().split())}
    counts = Counter(shapes)
    counts["<same>"] = sum(map(eq, own, own[1:]))
    found.update(f"p{a} {b}" for a, b in set(zip(shapes, shapes[1:], strict=False)))
    for shape, k in counts.items():
        found.add("s" + shape)
        found.update(f"{share}{shape}" for share in SHARES if k >= share * n)
    hashes = np.fromiter((xxhash.xxh32_intdigest(x) for x in found), dtype=np.int64, count=len(found))
    return np.unique(hashes % PLACES)


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of how much likelier each indicator is in good texts than in bad ones, smoothed."""
    counts = np.full((2, PLACES), SMOOTHING)
    for row, y in zip(rows, good.astype(int).tolist(), strict=True):
        counts[y][row] += 1
    totals = np.array([np.sum(good < 0.5), np.sum(good > 0.5)]) + 2 * SMOOTHING
    share = counts / totals[:, None]
    return np.log(share[1] / share[0])


def hinge_fit(rows: list[np.ndarray], good: np.ndarray, scale: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights of the indicators and an intercept by dual coordinate descent; rows have length one.

    Rarer labels cost more, in proportion.
    """
    y = np.where(good > 0.5, 1.0, -1.0)
    values = [scale[r] / max(1e-12, math.sqrt(float((scale[r] ** 2).sum()) + 1e-12)) for r in rows]
    cost = COST * len(y) / (2 * np.where(y > 0, np.sum(y > 0), np.sum(y < 0)).clip(1))
    norm = np.array([float((v * v).sum()) for v in values]) + 1.0  # the intercept is a feature of value one
    w, b, alpha = np.zeros(PLACES), 0.0, np.zeros(len(y))
    order, chance = np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(SWEEPS):
        chance.shuffle(order)
        largest = 0.0
        for i in order.tolist():
            row, value = rows[i], values[i]
            gradient = y[i] * (float(w[row] @ value) + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[row] += step * value
                b += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-3:
            break
    return w, b


def margins(rows: list[np.ndarray], weights: np.ndarray, intercept: float, scale: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))
    for i, r in enumerate(rows):
        v = scale[r]
        out[i] = float(weights[r] @ v) / max(1e-12, math.sqrt(float((v * v).sum()) + 1e-12)) + intercept
    return out


def calibrated(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margin to probability, by Newton steps with a weak prior."""
    slope, offset = 2.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = np.array([((p - good) * margin).sum() + 0.01 * (slope - 2), (p - good).sum() + 0.01 * offset])
        s = p * (1 - p)
        h = np.array([[(s * margin * margin).sum() + 0.01, (s * margin).sum()], [(s * margin).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


MODEL = "scale binary, weights binary, intercept double, slope double, offset double"


def fitted(rows: pd.DataFrame) -> pd.DataFrame:
    """The model of the labelled feature rows (``places``, ``good``, ``spare`` for calibration)."""
    rows = rows.sort_values("doc_id")
    good, spare = rows["good"].to_numpy(dtype=float), rows["spare"].to_numpy(dtype=bool)
    places = [np.frombuffer(x, dtype="<i4").astype(np.int64) for x in rows["places"]]
    fit = [p for p, s in zip(places, spare, strict=True) if not s]
    if len(set(good[~spare])) < 2:
        zeros = np.zeros(PLACES).tobytes()
        return pd.DataFrame([(zeros, zeros, 0.0, 0.0, 0.0)], columns=["scale", "weights", "intercept", "slope", "offset"])
    scale = log_count_ratios(fit, good[~spare])
    weights, intercept = hinge_fit(fit, good[~spare], scale)
    held = [p for p, s in zip(places, spare, strict=True) if s]
    slope, offset = calibrated(margins(held, weights, intercept, scale), good[spare]) if held else (2.0, 0.0)
    return pd.DataFrame([(scale.tobytes(), weights.tobytes(), intercept, slope, offset)], columns=["scale", "weights", "intercept", "slope", "offset"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> pd.Series:
    """The model, of bounded size, from a bounded sample of the labelled rows that aren't held out."""
    own = document_columns(labels, "doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("other")).where("good = other")
    chosen = own.select("doc_id", "good").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)

    def extract(batches):
        for batch in slices(batches):
            found = [features(t).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(found, pa.binary())], ["doc_id", "good", "places"])

    texts = document_columns(docs, "doc_id", "text").join(F.broadcast(staged(chosen, "labels")), "doc_id")
    rows = texts.select("doc_id", F.col("good").cast("int").alias("good"), "text").mapInArrow(extract, "doc_id long, good int, places binary")
    rows = rows.dropDuplicates(["doc_id"]).withColumn("spare", F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(CALIBRATION)) == 0)
    model = rows.groupBy(F.lit(0).alias("_all")).applyInPandas(fitted, MODEL).toPandas()
    if not len(model):
        zeros = np.zeros(PLACES).tobytes()
        return pd.Series({"scale": zeros, "weights": zeros, "intercept": 0.0, "slope": 0.0, "offset": 0.0})
    return model.iloc[0]


def _scorer(spark: SparkSession, model: pd.Series):
    shared = spark.sparkContext.broadcast(dict(model))

    def score(texts: list[str | None]) -> np.ndarray:
        m = shared.value
        scale, weights = (np.frombuffer(m[k], dtype=np.float64) for k in ("scale", "weights"))
        z = m["slope"] * margins([features(t) for t in texts], weights, m["intercept"], scale) + m["offset"]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every document."""
    score = _scorer(docs.sparkSession, train(docs, labels))

    def work(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(batch.column("text").to_pylist()), pa.float64())], ["doc_id", "score"])

    return document_columns(docs, "doc_id", "text").mapInArrow(work, "doc_id long, score double")


def accepted(docs: DataFrame, labels: DataFrame, least: float = ACCEPTED) -> DataFrame:
    """The documents (all columns) whose score reaches ``least``."""
    score = _scorer(docs.sparkSession, train(docs, labels))

    def work(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(score(batch.column("text").to_pylist()) >= least))

    return docs.mapInArrow(work, docs.schema)


@query("op6_nb_svm")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))
