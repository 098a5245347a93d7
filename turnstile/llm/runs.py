"""Periodic runs of words, found through a recompression grammar.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of a text (null: none), numbered
from 0.  A run is a stretch of consecutive words with smallest period q (words
q apart are equal) and length >= max(6, 4q) that no neighbouring word extends
keeping period q.  A word is dropped where a run holds it after the run's first
q words; the kept words joined by one space are the collapsed text.

Before the search some documents get a periodic tail planted (fixed by the
contract): with h = crc32 of the decimal doc_id and g = h // 10, where
h % 10 == 0 and n > 0, word i >= a becomes word a + (i - a) % p of the
original, a = g % n, p = 1 + (n - a) // (3 + g % 8).

Method.  Recompression (Jez) turns the word ids of a document into a
run-length grammar: block compression replaces each maximal block of equal
symbols by one symbol (symbol, count), pair compression replaces each pair
``ab`` with a in a left set and b in a right set by one symbol; the sets are
drawn per symbol by a hash bit, so equal texts are parsed alike except near
their ends.  Each level keeps its symbols' starts, ends, ids (equal id, equal
expansion) and lengths.  A longest common extension (LCE) of two places walks
this hierarchy: it climbs a level while both places start equal symbols
there, moves over equal symbols, and descends where they differ, until words
differ; backwards alike on ends.  Candidates lie on a harmonic grid: for each
period q a run of length >= 4q holds both j and j + q for some j in multiples
of 3q, so words j and j + q must be equal, and since a run has at least
max(5, 3q) places i with word i equal to word i + q in a row, j lies among
three of them in a row (a necessary test, so no run is lost); each such j is
extended by one
forward and one backward LCE, giving the maximal stretch of period q around
it.  Stretches of length >= max(6, 4q) are runs once the same stretch is kept
with its smallest q only (by Fine and Wilf a smaller period of so long a
stretch divides q, and its grid finds the same stretch).  All candidates of a
document are extended together, in numpy.

Spark deals documents over tasks and computes counts, the longest run and the
digests from the returned runs and collapsed text.

Edge cases: null or empty texts have no words (no run; four nulls; digests
of the empty string); a null doc_id is not planted (no crc32); very long texts
are handled whole, in memory of their own size times a small constant; each
input row gives one result row, repeated rows equal ones; an empty table gives
no rows; other columns of ``documents`` are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, table

SHORTEST, TIMES, GRID = 6, 4, 3
_DELIMITER = re.compile("[\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Rounds of block and pair compression at most; each round shrinks a text by a quarter on average.
_ROUNDS = 256


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words after the contract's planted periodic tail."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _left(sym: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = sym.astype(np.uint64) * _MIX[0] + np.uint64(level) * _MIX[1]
        x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return ((x >> np.uint64(33)) & np.uint64(1)).astype(bool)


class Grammar:
    """The recompression levels of one sequence of ids, with LCE queries."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n, self.stride = n, n + 1
        seq = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        start, length = np.arange(n, dtype=np.int64), np.ones(n, dtype=np.int64)
        levels = [(seq, start, length)]
        for r in range(_ROUNDS):
            if len(seq) <= 1:
                break
            heads = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            if len(heads) < len(seq):  # block compression
                counts = np.diff(np.append(heads, len(seq)))
                seq = np.unique(seq[heads] * self.stride + counts, return_inverse=True)[1].astype(np.int64)
                start, length = start[heads], np.add.reduceat(length, heads)
                levels.append((seq, start, length))
            if len(seq) <= 1:
                break
            side = _left(seq, r)
            at = np.flatnonzero(side[:-1] & ~side[1:])  # pair compression: left then right
            if len(at):
                keep = np.ones(len(seq), dtype=bool)
                keep[at + 1] = False
                second = np.full(len(seq), -1, dtype=np.int64)
                second[at] = seq[at + 1]
                length = length.copy()
                length[at] += length[at + 1]
                seq = np.unique((seq * (self.stride + 1) + second + 1)[keep], return_inverse=True)[1].astype(np.int64)
                start, length = start[keep], length[keep]
                levels.append((seq, start, length))
        self.top = len(levels) - 1
        self.key = np.concatenate([lv * self.stride + s for lv, (_, s, _) in enumerate(levels)])
        self.end = np.concatenate([lv * self.stride + s + ln for lv, (_, s, ln) in enumerate(levels)])
        self.sym = np.concatenate([q for q, _, _ in levels])
        # Words from a symbol to the end of its block of equal symbols, and from the block's start to the symbol's end.
        ahead, behind = zip(*(_blocks(*lv) for lv in levels))
        self.ahead, self.behind = np.concatenate(ahead), np.concatenate(behind)

    def _find(self, keys: np.ndarray, level: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = level * self.stride + place
        i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return keys[i] == k, i

    def _extend(self, x: np.ndarray, y: np.ndarray, keys: np.ndarray, sign: int) -> np.ndarray:
        """Common extension: climb where both places start (end) equal symbols one level up, else cross the
        shorter of their blocks of one equal symbol, else descend; at level 0 unequal words end it."""
        rest = self.ahead if sign > 0 else self.behind
        out = np.zeros(len(x), dtype=np.int64)
        level = np.zeros(len(x), dtype=np.int64)
        act = np.arange(len(x))
        while len(act):
            px, py, lv = x[act] + sign * out[act], y[act] + sign * out[act], level[act]
            up = np.minimum(lv + 1, self.top)
            hx, ix = self._find(keys, up, px)
            hy, iy = self._find(keys, up, py)
            climb = (lv < self.top) & hx & hy & (self.sym[ix] == self.sym[iy])
            hx, jx = self._find(keys, lv, px)
            hy, jy = self._find(keys, lv, py)
            stay = ~climb & hx & hy & (self.sym[jx] == self.sym[jy])
            cross = np.minimum(rest[jx], rest[jy])
            out[act] += np.where(climb, np.minimum(rest[ix], rest[iy]), np.where(stay, cross, 0))
            level[act] = np.where(climb, up, np.where(stay, lv, lv - 1))
            act = act[climb | stay | (lv > 0)]
        return out

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at x and y."""
        return self._extend(x, y, self.key, 1)

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix of the prefixes ending before x and y."""
        return self._extend(x, y, self.end, -1)


def _blocks(seq: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.concatenate(([True], seq[1:] != seq[:-1]))
    block = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(seq)) - 1
    end = start + length
    return end[tails][block] - start, end - start[heads][block]


def _equal(ids: np.ndarray, i: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether word i equals word i + period, false where either is outside the text."""
    n = len(ids)
    inside = (i >= 0) & (i + period < n)
    return inside & (ids[np.clip(i, 0, n - 1)] == ids[np.clip(i + period, 0, n - 1)])


def runs_of(ids: np.ndarray) -> np.ndarray:
    """Runs as rows (start, length, period), sorted by start then period."""
    n = len(ids)
    if n < SHORTEST:
        return np.zeros((0, 3), dtype=np.int64)
    q = np.arange(1, n // TIMES + 1, dtype=np.int64)
    count = (n - q - 1) // (GRID * q) + 1
    period = np.repeat(q, count)
    first = np.repeat(np.cumsum(count) - count, count)
    j = (np.arange(len(period)) - first) * GRID * period
    same = ids[j] == ids[j + period]
    j, period = j[same], period[same]
    # A run of period q holds at least max(5, 3q) consecutive places i with word i equal to word i + q, and the grid
    # place lies among them, so three such places in a row include it: a necessary test that drops chance equalities.
    equal = {d: _equal(ids, j + d, period) for d in (-2, -1, 1, 2)}
    equal[0] = np.ones(len(j), dtype=bool)
    three = np.zeros(len(j), dtype=bool)
    for first in (-2, -1, 0):
        three |= equal[first] & equal[first + 1] & equal[first + 2]
    j, period = j[three], period[three]
    if not len(j):
        return np.zeros((0, 3), dtype=np.int64)
    g = Grammar(ids)
    ahead, behind = g.forward(j, j + period), g.backward(j, j + period)
    start, length = j - behind, behind + period + ahead
    run = length >= np.maximum(SHORTEST, TIMES * period)
    found = np.unique(np.stack([start[run], length[run], period[run]], 1), axis=0)
    if not len(found):
        return found
    # One row per stretch, with its smallest period.
    lowest = np.concatenate(([True], (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])))
    found = found[lowest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


_OUT = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        runs, collapsed = [], []
        ids_of = b.column("doc_id").to_pylist()
        for doc_id, text in zip(ids_of, b.column("text").to_pylist()):
            words = planted([w for w in _DELIMITER.split(text) if w] if text else [], doc_id)
            ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if words else np.zeros(0, dtype=np.int64)
            found = runs_of(ids)
            cover = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(cover, found[:, 0] + found[:, 2], 1)
            np.add.at(cover, found[:, 0] + found[:, 1], -1)
            runs.append([{"start": int(s), "length": int(ln), "period": int(p)} for s, ln, p in found])
            if len(found):
                gone = np.cumsum(cover)[: len(words)] > 0
                collapsed.append(" ".join(w for w, d in zip(words, gone) if not d))
            else:
                collapsed.append(" ".join(words))
        yield pa.RecordBatch.from_pydict({"doc_id": ids_of, "runs": runs, "collapsed": collapsed}, schema=_ARROW)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period, exponent_milli of the longest run, runs_sha256, collapsed_sha256."""
    found = document_columns(docs, "doc_id", "text").mapInArrow(_search, _OUT)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("b"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs",
        F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.expr("(1000 * -b.l) div b.p").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


@query("op13_recompression_runs")
def op13_recompression_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(table(spark, folder, "documents"))
