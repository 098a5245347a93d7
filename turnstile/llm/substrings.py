"""Repeated passages removed by level-wise doubling of windows.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of a text, unchanged.  A window is
``WINDOW`` (20) consecutive words of one document.  Each word covered by a
window whose word sequence also starts earlier -- in a document of smaller
``doc_id``, or earlier in the same document -- is removed; windows are judged
on the input, not on what is left.

Method: windows of ``BASE`` (5) words are hashed and counted; only those whose
sequence occurs at least twice survive.  A window of twice the length is a
candidate only where both its halves survived the level below (a repeated
sequence has repeated halves, so nothing is lost), is hashed from the hashes of
its halves, counted, and kept if repeated; 5 -> 10 -> 20.  At the last level
the earliest occurrence of each repeated sequence stays and every later one is
removed.

What moves: documents are numbered words in blocks of about ``BLOCK_WORDS``,
written once.  At each level a block sends each of its distinct keys once, in
ascending order to the groups of their ranges, as compressed differences; a
group tells it back one bit a key, and the block works its windows out anew
from the words and the bits.  So a sequence that a third of all documents share
is one key a block.  Keys have 40 bits below the last level, where two
sequences of one key only make a further candidate, and 96 bits with the
block's earliest place (doc_id, sub, start) at the last.  At the first level no
answers wait for a block, so its keys are made where it lies; from the second
on block and answers are brought together.

Only documents of at least 20 words take part in the levels: a shorter one has
no window and so neither loses nor causes a removal.

Edge cases: null and empty texts have no words (n_words 0, kept_sha256 of the
empty string); a very long text is a block of its own, worked on in one task
with memory a small multiple of its words;
a null doc_id sorts before all others;
rows with the same doc_id and different texts are ordered by a hash of the
text (``sub``) after the doc_id; identical repeated rows start their windows at
equal places, so neither removes the other, and give equal result rows; an
empty table gives no rows; other columns of ``documents`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table, tasks
from turnstile.llm.token_files import slices, squeezed, unsqueezed
from turnstile.llm.words import mixed

WINDOW = 20
BASE = 5
#: Words and documents of a block, about; a longer document is a block of its own.
BLOCK_WORDS, BLOCK_DOCUMENTS = 1 << 19, 1 << 14
#: Words whose windows are compared in one group, about.
GROUP_WORDS = 1 << 21
#: Bits of the keys below the last level, where an equal key only makes a further candidate.
KEY_BITS = 40
PHI = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = "block long, doc_ids array<long>, subs array<long>, lengths array<long>, n_words long, words binary, vocabulary binary"
_ANSWER = "block long, level int, part int, bits binary"
_KEYS = "part int, block long, keys binary, again binary"
_PLACES = "part int, block long, keys binary, marks binary, docs binary, starts binary, doc_ids array<long>, subs array<long>"


class Vocabulary(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of numbered words; the numbers are places in the block's own vocabulary."""
    block = TaskContext.get().partitionId() << 33
    doc_ids, subs, numbers, vocabulary = [], [], [], Vocabulary()

    def row() -> pa.RecordBatch:
        words = np.concatenate(numbers)
        lengths = [len(x) for x in numbers]
        own = zstandard.compress(b"\n".join(vocabulary), 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                *(pa.array([x], pa.list_(pa.int64())) for x in (doc_ids, subs, lengths)),
                pa.array([len(words)], pa.int64()),
                pa.array([squeezed(words.tobytes())], pa.binary()),
                pa.array([own], pa.binary()),
            ],
            ["block", "doc_ids", "subs", "lengths", "n_words", "words", "vocabulary"],
        )

    n = 0
    for batch in slices(batches):
        for doc_id, sub, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "sub", "text")), strict=True):
            words = text.split() if text else []  # bytes: cut at \x20 and \x09-\x0D alone
            doc_ids.append(doc_id)
            subs.append(sub)
            numbers.append(np.fromiter(map(vocabulary.__getitem__, words), dtype="<u4", count=len(words)))
            n += len(words)
            if n >= BLOCK_WORDS or len(doc_ids) >= BLOCK_DOCUMENTS:
                yield row()
                block, n = block + 1, 0
                doc_ids, subs, numbers, vocabulary = [], [], [], Vocabulary()
    if doc_ids:
        yield row()


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers: their differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u8").ravel(), dtype=np.uint64)


def ahead(a: np.ndarray, k: int) -> np.ndarray:
    """The value ``k`` places further on; zero beyond the end."""
    out = np.zeros_like(a)
    out[: max(0, len(a) - k)] = a[k:]
    return out


def bits_of(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=n).astype(bool)


class _Block:
    """The windows of one block's documents, level by level."""

    def __init__(self, row: dict, answers: list[dict], parts: int, window: int, base: int) -> None:
        self.row, self.answers, self.parts, self.window, self.base = row, answers, parts, window, base
        raw = zstandard.decompress(row["vocabulary"])
        self.vocabulary = raw.split(b"\n") if raw else []
        self.words = unsqueezed([row["words"]])
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        ends = np.cumsum(self.lengths)
        self.doc = np.repeat(np.arange(len(ends)), self.lengths)
        self.start = np.arange(len(self.words)) - (ends - self.lengths)[self.doc]
        #: Words from here to the end of the document; 0 where it is too short for a window.
        self.left = np.where(self.lengths >= window, self.lengths, 0)[self.doc] - self.start

    def _keys(self, seed: int) -> np.ndarray:
        """A hash of the ``base`` words from each place on."""
        own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocabulary), dtype=np.uint64, count=len(self.vocabulary))
        h = own[self.words]
        out = np.zeros(len(h), dtype=np.uint64)
        for k in range(self.base):
            out = mixed(out * PHI + ahead(h, k) + np.uint64(k))
        return out

    def candidates(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows of ``level`` words whose halves are repeated, and two hashes of each (the second at the last level alone)."""
        last = level == self.window
        one = self._keys(0)
        two = self._keys(1) if last else one
        length, fits = self.base, np.ones(len(one), dtype=bool)
        while True:
            starts = np.flatnonzero(fits & (self.left >= length))
            if length == level:
                return starts, one[starts], two[starts]
            keys, own = np.unique(short(one[starts]), return_inverse=True)
            fits = np.zeros(len(one), dtype=bool)
            fits[starts] = self.told(keys, length)[own]
            fits &= ahead(fits, length)
            one = mixed(mixed(one) * PHI + ahead(one, length) + np.uint64(length))
            two = mixed(mixed(two) * PHI + ahead(two, length) + np.uint64(length)) if last else one
            length *= 2

    def told(self, keys: np.ndarray, level: int, bits: int = KEY_BITS) -> np.ndarray:
        """What the groups answered about the ascending ``keys`` of a level."""
        out, cuts = np.zeros(len(keys), dtype=bool), cuts_of(keys, self.parts, bits)
        for a in self.answers:
            if a["level"] == level:
                lo, hi = cuts[a["part"]], cuts[a["part"] + 1]
                out[lo:hi] = bits_of(a["bits"], hi - lo)
        return out

    def ranks(self) -> np.ndarray:
        """The documents' order by (doc_id, sub), null ids first; equal ones share a rank."""
        known, ids, subs = _order_of(self.row["doc_ids"], self.row["subs"])
        order = np.lexsort((subs, ids, known))
        new = np.ones(len(order), dtype=bool)
        if len(order):
            new[1:] = (np.diff(subs[order]) != 0) | (np.diff(ids[order]) != 0) | (np.diff(known[order]) != 0)
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    def earliest(self) -> tuple[np.ndarray, ...]:
        """Windows of the last level in order of key and place: start, hashes, place, and where a new key begins."""
        starts, one, two = self.candidates(self.window)
        two = two.astype("<u4")
        place = (self.ranks()[self.doc[starts]] << 32) | self.start[starts]
        order = np.lexsort((place, two, one))
        starts, one, two, place = starts[order], one[order], two[order], place[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return starts, one, two, place, new

    def later(self) -> np.ndarray:
        """Starts of the windows whose words start earlier too."""
        starts, one, _, place, new = self.earliest()
        if not len(starts):
            return starts
        own = np.cumsum(new) - 1
        elsewhere = self.told(one[new], self.window, 64)
        return np.sort(starts[elsewhere[own] | (place > place[new][own])])


def short(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - KEY_BITS)


def cuts_of(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where each group's range begins among ascending keys of so many bits."""
    edges = np.array([(p << bits) // parts for p in range(1, parts)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _order_of(doc_ids: list, subs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known = np.array([i is not None for i in doc_ids], dtype=bool)
    return known.astype(np.int8), np.array([i or 0 for i in doc_ids], dtype=np.int64), np.array(subs, dtype=np.int64)


def _keys_of(block: _Block, level: int) -> pa.Table:
    """Each group's distinct keys of a block, and which of them the block holds twice."""
    _, one, _ = block.candidates(level)
    keys, counts = np.unique(short(one), return_counts=True)
    cuts, rows = cuts_of(keys, block.parts, KEY_BITS), []
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        lo, hi = cuts[p], cuts[p + 1]
        rows.append({"part": p, "block": block.row["block"], "keys": packed(keys[lo:hi]), "again": np.packbits(counts[lo:hi] > 1).tobytes()})
    return pa.Table.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("again", pa.binary())]))


def _places_of(block: _Block) -> pa.Table:
    """Each group's distinct windows of the last level, with their earliest place in the block."""
    _, one, two, place, new = block.earliest()
    one, two, place = one[new], two[new], place[new]
    rank, start = place >> 32, (place & 0xFFFFFFFF).astype("<u4")
    doc_of = np.zeros(len(block.lengths) + 1, dtype=np.int64)
    doc_of[block.ranks()] = np.arange(len(block.lengths))  # any document of the rank: they share id and sub
    cuts, rows = cuts_of(one, block.parts, 64), []
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[p], cuts[p + 1])
        used, at = np.unique(doc_of[rank[own]], return_inverse=True)
        rows.append({
            "part": p, "block": block.row["block"], "keys": packed(one[own]), "marks": two[own].tobytes(),
            "docs": squeezed(at.astype("<u4").tobytes()), "starts": squeezed(start[own].tobytes()),
            "doc_ids": [block.row["doc_ids"][i] for i in used.tolist()], "subs": [block.row["subs"][i] for i in used.tolist()],
        })
    binary = ("keys", "marks", "docs", "starts")
    lists = pa.list_(pa.int64())
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in binary), ("doc_ids", lists), ("subs", lists)])
    return pa.Table.from_pylist(rows, schema=schema)


def _told(rows: pa.Table, sizes: list[int], bits: np.ndarray, level: int) -> pa.Table:
    """The answer to each block: a bit for each key it sent; blocks without any get none."""
    out, at = [], 0
    for block, part, n in zip(rows.column("block").to_pylist(), rows.column("part").to_pylist(), sizes, strict=True):
        own = bits[at : at + n]
        at += n
        if own.any():
            out.append({"block": block, "level": level, "part": part, "bits": np.packbits(own).tobytes()})
    return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("level", pa.int32()), ("part", pa.int32()), ("bits", pa.binary())]))


def _repeated(level: int):
    def work(rows: pa.Table) -> pa.Table:
        sets = [unpacked(x) for x in rows.column("keys").to_pylist()]
        sizes = [len(x) for x in sets]
        again = np.concatenate([bits_of(x, n) for x, n in zip(rows.column("again").to_pylist(), sizes, strict=True)])
        _, own, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        more = counts > 1
        more[own[again]] = True
        return _told(rows, sizes, more[own], level)

    return work


def _earlier(level: int):
    """A bit for each key of each block: another block holds an earlier place of it."""

    def work(rows: pa.Table) -> pa.Table:
        known, ids, subs, sizes = [], [], [], []
        for doc_ids, own_subs, docs in zip(*(rows.column(c).to_pylist() for c in ("doc_ids", "subs", "docs")), strict=True):
            at = unsqueezed([docs])
            sizes.append(len(at))
            for column, values in zip((known, ids, subs), _order_of(doc_ids, own_subs), strict=True):
                column.append(values[at])
        place = [unsqueezed(rows.column("starts").to_pylist()), *(np.concatenate(x) for x in (subs, ids, known))]
        key = [np.frombuffer(b"".join(rows.column("marks").to_pylist()), dtype="<u4"), np.concatenate([unpacked(x) for x in rows.column("keys").to_pylist()])]
        order = np.lexsort((*place, *key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in key], axis=0)
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        bits = np.empty(len(order), dtype=bool)
        bits[order] = np.any([x[order] != x[first] for x in place], axis=0)
        return _told(rows, sizes, bits, level)

    return work


def _each(blocks: DataFrame, found: DataFrame, work, schema: str, parts: int, window: int, base: int) -> DataFrame:
    """``work`` on every block with the answers so far."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        told = answers.to_pylist()
        return pa.concat_tables([work(_Block(row, told, parts, window, base)) for row in block.to_pylist()])

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, schema)


def _first(blocks: DataFrame, work, schema: str, parts: int, window: int, base: int) -> DataFrame:
    """``work`` on every block before any answer: where the blocks lie, without moving them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                yield from work(_Block(row, [], parts, window, base)).to_batches()

    return blocks.mapInArrow(run, schema)


def _levels(docs: DataFrame, window: int, base: int, work, schema: str) -> DataFrame:
    """``work`` on every block when all levels are told."""
    if window % base or (window // base) & (window // base - 1):
        raise ValueError("the window must be the base times a power of two")
    spark = docs.sparkSession
    d = document_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("sub"), F.col("text").cast("binary").alias("text"))
    blocks = staged(d.mapInArrow(_blocks, _BLOCK), "doubling-blocks")
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(tasks(spark), -(-words // GROUP_WORDS))
    found, level = spark.createDataFrame([], _ANSWER), base
    while level < window:
        each = _first if level == base else partial(_each, found=found)
        keys = each(blocks, work=lambda block, level=level: _keys_of(block, level), schema=_KEYS, parts=parts, window=window, base=base)
        told = staged(keys.groupBy("part").applyInArrow(_repeated(level), _ANSWER), f"doubling-{level}")
        found, level = found.unionAll(told), 2 * level
    places = _each(blocks, found, _places_of, _PLACES, parts, window, base)
    found = found.unionAll(staged(places.groupBy("part").applyInArrow(_earlier(window), _ANSWER), "doubling-firsts"))
    return _each(blocks, found, work, schema, parts, window, base)


def _starts(block: _Block) -> pa.Table:
    later = block.later()
    of = [pa.array([block.row[c][i] for i in block.doc[later].tolist()], pa.int64()) for c in ("doc_ids", "subs")]
    return pa.table([*of, pa.array(block.start[later], pa.int32())], names=["doc_id", "sub", "start"])


def _kept(block: _Block) -> pa.Table:
    cover = np.zeros(len(block.words) + block.window + 1, dtype=np.int64)
    later = block.later()
    cover[later] += 1
    cover[later + block.window] -= 1
    gone = np.cumsum(cover)[: len(block.words)] > 0
    removed, digests, at = [], [], 0
    for n in block.lengths.tolist():
        out = gone[at : at + n]
        kept = b" ".join(map(block.vocabulary.__getitem__, block.words[at : at + n][~out].tolist()))
        removed.append(int(out.sum()))
        digests.append(hashlib.sha256(kept).hexdigest())
        at += n
    return pa.table([pa.array(block.row["doc_ids"], pa.int64()), pa.array(block.lengths), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def later_starts(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """(doc_id, sub, start) of every window whose word sequence starts earlier too."""
    return _levels(docs, window, base, _starts, "doc_id long, sub long, start int")


def deduplicated(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept_sha256 (see the module)."""
    return _levels(docs, window, base, _kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")


@query("op12_doubling_dedup")
def op12_doubling_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"))
