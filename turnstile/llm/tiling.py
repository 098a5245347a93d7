"""Benchmark decontamination by greedy string tiling.

Runs of five words that a document shares with a benchmark item seed the
comparison.  For each seeded pair the longest common runs of words that are
still unmarked on both sides are marked as tiles, longest first, down to five
words; runs are found by running Karp-Rabin hashes and compared word by word.
The part of the item's words under tiles is its coverage, which does not depend
on the order of the passages in the document.

The benchmark is taken in blocks of bounded size, each of which goes to the
tasks as a broadcast; documents are streamed past it and not shuffled.  Items
shorter than five words must occur as a whole; items without words and null
texts match nothing.  Null ids and repeated rows are kept as rows of their own;
of equal items each is reported.  Further columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, table
from turnstile.llm.token_files import slices
from turnstile.llm.words import words

SHORTEST_TILE, COVERAGE = 5, 0.8
#: Bytes of benchmark text broadcast at once; a larger benchmark takes more passes over the documents.
BLOCK_BYTES = 8_000_000
#: Base of the running hash, modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``n`` ids, from prefix hashes; ids count from 0."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    power = np.cumprod(np.full(len(ids) + 1, BASE, dtype=np.uint64))
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * power[: len(ids)])))
    # Each run's hash is brought to the same power of the base.
    return (prefix[n:] - prefix[:-n]) * power[::-1][: len(ids) - n + 1]


def tiles(text: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(start in text, start in item, length) of greedy tiles, longest first, ties from left to right.

    Negative ids in ``text`` match nothing.
    """
    free_text, free_item, found = text >= 0, np.ones(len(item), dtype=bool), []
    n = len(item)
    whole = np.concatenate((text, np.full(1, -1), item))  # hashed together, so that powers agree
    at_item = len(text) + 1
    while n >= shortest:
        hashes = run_hashes(whole + 1, n)
        of_text, of_item = hashes[: max(0, len(text) - n + 1)], hashes[at_item:]
        open_text = _open(free_text, n)
        open_item = _open(free_item, n)
        places: dict[int, list[int]] = {}
        for q in np.flatnonzero(open_item).tolist():
            places.setdefault(int(of_item[q]), []).append(q)
        marked = False
        if places and open_text.any():
            candidates = np.flatnonzero(open_text & np.isin(of_text, np.fromiter(places, dtype=np.uint64, count=len(places))))
            for p in candidates.tolist():
                for q in places.get(int(of_text[p]), ()):
                    if free_text[p : p + n].all() and free_item[q : q + n].all() and (text[p : p + n] == item[q : q + n]).all():
                        free_text[p : p + n], free_item[q : q + n], marked = False, False, True
                        found.append((p, q, n))
                        break
        n = n - 1 if not marked else min(n - 1, _longest(free_item))
    return found


def _open(free: np.ndarray, n: int) -> np.ndarray:
    """Starts of runs of ``n`` free places."""
    if len(free) < n:
        return np.zeros(0, dtype=bool)
    taken = np.concatenate(([0], np.cumsum(~free)))
    return taken[n:] == taken[:-n]


def _longest(free: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
    return int((edges[1::2] - edges[::2]).max()) if len(edges) else 0


class Seeds:
    """The runs of words of a block of items by hash, made in each task from the items' texts."""

    def __init__(self, items: list[tuple[int, str]], shortest: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)], dtype=np.int64)
            if len(ids):
                self.items.append((item_id, ids, min(shortest, len(ids))))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({x[2] for x in self.items}):
            keys, owners = [], []
            for k, (_, ids, own) in enumerate(self.items):
                if own == n:
                    found = np.unique(self.hashes(ids, n))
                    keys.append(found)
                    owners.append(np.full(len(found), k))
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(key, kind="stable")
            self.by_length[n] = key[order], owner[order]

    @staticmethod
    def hashes(ids: np.ndarray, n: int) -> np.ndarray:
        """Hash of every run, comparable between texts (a run's own powers start at one)."""
        if len(ids) < n:
            return np.zeros(0, dtype=np.uint64)
        out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = out * BASE + ids[k : len(ids) - n + 1 + k].astype(np.uint64) + np.uint64(1)
        return out

    def matches(self, text: str | None, coverage: float) -> list[tuple[int, float, int, int]]:
        """(item, coverage, number of tiles, words under tiles) of the items that the text holds."""
        own = words(text)
        ids = np.fromiter(map(self.vocabulary.get, own, [-1] * len(own)), dtype=np.int64, count=len(own))
        near: dict[int, list[tuple[np.ndarray, int]]] = {}
        for n, (key, owner) in self.by_length.items():
            known = _open(ids >= 0, n)
            at = np.flatnonzero(known)
            if not len(at):
                continue
            found = self.hashes(ids, n)[at]
            lo, hi = np.searchsorted(key, found, "left"), np.searchsorted(key, found, "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for k in owner[a:b].tolist():
                    near.setdefault(k, []).append((p, n))
        out = []
        for k, seeds in near.items():
            item_id, item, shortest = self.items[k]
            kept = np.zeros(len(ids), dtype=bool)
            for p, n in seeds:
                kept[p : p + n] = True
            places = np.flatnonzero(kept)
            # Words beyond the item's seeds can't be under a tile: gaps become one word that matches nothing.
            gaps = np.flatnonzero(np.diff(places) > 1) + 1
            marked = tiles(np.insert(ids[places], gaps, -1), item, shortest)
            covered = sum(t[2] for t in marked)
            if covered >= coverage * len(item):
                out.append((item_id, covered / len(item), len(marked), covered))
        return sorted(out, key=lambda x: (x[0] is not None, x[0]))


_SEEDS: dict[str, Seeds] = {}


def blocks_of(items: DataFrame, id_column: str, block_bytes: int) -> list[list[tuple[int, str]]]:
    """The items in blocks of about that many bytes; one block at a time is held on the driver."""
    rows = document_columns(items, id_column, "text").where("text is not null").toDF("id", "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    return [[(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()] for b in range(blocks)]


def leaks(docs: DataFrame, items: DataFrame, shortest: int = SHORTEST_TILE, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles and tiled_words of every pair whose coverage reaches the threshold."""
    out = None
    for block in blocks_of(items, "item_id", block_bytes):
        find = _finder(docs.sparkSession, block, shortest)

        def work(batches, find=find):
            for batch in slices(batches):
                rows = [(doc, *m) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for m in find(text, coverage)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "coverage", "n_tiles", "tiled_words"])

        own = document_columns(docs, "doc_id", "text").mapInArrow(work, "doc_id long, item_id long, coverage double, n_tiles int, tiled_words int")
        out = own if out is None else out.unionByName(own)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, shortest: int = SHORTEST_TILE, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents (all columns) that hold no item up to the threshold."""
    for block in blocks_of(items, "item_id", block_bytes):
        find = _finder(docs.sparkSession, block, shortest)

        def work(batches, find=find):
            for batch in slices(batches):
                yield batch.filter(pa.array([not find(text, coverage) for text in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def _finder(spark: SparkSession, block: list[tuple[int, str]], shortest: int):
    shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

    def find(text: str | None, coverage: float) -> list[tuple[int, float, int, int]]:
        if name not in _SEEDS:
            _SEEDS.clear()
            _SEEDS[name] = Seeds(shared.value, shortest)
        return _SEEDS[name].matches(text, coverage)

    return find


@query("op2_string_tiling")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
