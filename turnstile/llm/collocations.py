"""Phrase collocations mined by SON partitioning.

Texts have A-Z lower-cased (nothing else), are cut into pieces at
``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``.  Per language
(null: ``und``) ``n`` counts all word occurrences and ``f(phrase)`` every
contiguous occurrence of the phrase inside one piece, overlaps included.

Method (Savasere, Omiecinski and Navathe): documents are numbered words in
shards of about ``SHARD_WORDS``, written once.  Each shard is mined completely,
in its own task, for phrases of one to four words, each locally frequent if it
reaches the support lowered in proportion to the shard's share of its
language's words (``f_shard * n >= support * n_shard``, in integers).  A phrase
frequent in the whole language is frequent in at least one shard (else its
shard counts would sum below the support), so the union of locally frequent
phrases holds every answer.  Where shards are many, the lowered support is one
and that union is every phrase; so the shards' counts come along, and a phrase
whose counts do not sum to the support leaves the union.  Phase 2 goes through
all shards again and counts these candidates alone, exactly, by phrase text,
summed per shard before the shuffle.

Phrases of phase 1 move as 40-bit hashes in ascending order, compressed, once a
shard, to groups of their ranges (an equal hash only makes a further
candidate), and groups tell each shard its candidates.  So a phrase that all
documents hold is one row a shard.

Scoring: a candidate of 2 to 4 words with ``a = f >= support`` is cut after
each k of its words; ``l`` and ``r`` are the counts of both parts and the cut
scores ``floor(2000000 * a / (l + r))`` in decimal arithmetic (exact; the
quotient is at most 10^6 as l, r >= a).  The lowest-scoring cut counts, ties to
the smallest k.  A candidate whose words stand contiguously inside a longer
candidate with ``100 * f(longer) >= 80 * a`` is dropped.  Each language keeps
its first ``top`` by score desc, a desc, phrase asc (UTF-8 bytes), chosen per
(language, bucket) first so that a language holding most rows is ranked in
many tasks.

Edge cases: null or empty texts add no words; null lang is ``und``; very long
texts are a shard of their own, worked on in one task;
repeated rows count as often as they occur; an empty table or one without
candidates gives no rows; other columns of ``documents`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table, tasks
from turnstile.llm.substrings import KEY_BITS, PHI, Vocabulary, ahead, cuts_of, packed, short, unpacked
from turnstile.llm.token_files import slices, squeezed, unsqueezed
from turnstile.llm.words import mixed

SUPPORT = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
#: Words and documents of a shard, about; a longer document is a shard of its own.
SHARD_WORDS, SHARD_DOCUMENTS = 1 << 19, 1 << 14
#: Words whose phrases are compared in one group, about.
GROUP_WORDS = 1 << 21
#: Share of ``a`` that a longer candidate must reach to absorb a shorter one, in percent.
ABSORB = 80
#: Fixed values of the contract, for the SQL.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Piece delimiters turned into LF, blanks into one sign.
_SIGNS = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c in b" \t" else c for c in range(256))
_BLANK, _BREAK = 0, 1  # numbers of the empty word, which goes, and of the end of a piece
_SHARD = "shard long, langs array<string>, sizes array<long>, lengths array<long>, of array<int>, words binary, vocabulary binary"
_MINED = "part int, shard long, lang string, keys binary, counts binary, below long"
_TOLD = "shard long, lang string, part int, keys binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in shards of numbered words, with the number of words of each language."""
    shard = TaskContext.get().partitionId() << 33
    numbers, of, langs, vocabulary = [], [], Vocabulary(), Vocabulary({b"": _BLANK, b"\n": _BREAK})

    def row() -> pa.RecordBatch:
        words = np.concatenate(numbers)
        lengths = np.array([len(x) for x in numbers])
        sizes = np.bincount(np.repeat(of, lengths)[words != _BREAK], minlength=len(langs))
        lists = [(list(langs), pa.string()), (sizes.tolist(), pa.int64()), (lengths.tolist(), pa.int64()), (of, pa.int32())]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()),
                *(pa.array([x], pa.list_(kind)) for x, kind in lists),
                pa.array([squeezed(words.tobytes())], pa.binary()),
                pa.array([zstandard.compress(b" ".join(vocabulary), 1)], pa.binary()),
            ],
            ["shard", "langs", "sizes", "lengths", "of", "words", "vocabulary"],
        )

    n = 0
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = (text or b"").lower().translate(_SIGNS).replace(b"\n", b" \n ").split(b" ")  # lower() of bytes: A-Z alone
            words.append(b"\n")
            own = np.fromiter(map(vocabulary.__getitem__, words), dtype="<u4", count=len(words))
            numbers.append(own[own != _BLANK])
            of.append(langs[lang])
            n += len(numbers[-1])
            if n >= SHARD_WORDS or len(of) >= SHARD_DOCUMENTS:
                yield row()
                shard, n = shard + 1, 0
                numbers, of, langs, vocabulary = [], [], Vocabulary(), Vocabulary({b"": _BLANK, b"\n": _BREAK})
    if of:
        yield row()


class _Shard:
    """The phrases of one shard."""

    def __init__(self, row: dict, longest: int) -> None:
        self.row, self.longest = row, longest
        self.vocabulary = zstandard.decompress(row["vocabulary"]).split(b" ")
        self.words = unsqueezed([row["words"]])
        self.lang = np.repeat(np.array(row["of"], dtype=np.int64), row["lengths"])
        breaks = np.flatnonzero(self.words == _BREAK)
        at = np.arange(len(self.words))
        #: Words from here to the end of the piece.
        self.left = breaks[np.searchsorted(breaks, at)] - at if len(at) else at

    def keys(self) -> Iterator[np.ndarray]:
        """For phrases of 1, 2, ... words: a hash of the phrase from each place on."""
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary), dtype=np.uint64, count=len(self.vocabulary))
        h = own[self.words]
        out = np.zeros(len(h), dtype=np.uint64)
        for k in range(self.longest):
            out = mixed(out * PHI + ahead(h, k) + np.uint64(k))
            yield short(out)

    def starts(self, lang: int, k: int) -> np.ndarray:
        return np.flatnonzero((self.left >= k) & (self.lang == lang))


def _mine(shard: _Shard, shares: list[dict], parts: int) -> Iterator[dict]:
    """Phase 1: the shard's phrases with their counts; those above ``below`` are frequent at the support lowered to its share of the language."""
    every = list(shard.keys())
    for share in shares:
        lang = shard.row["langs"].index(share["lang"])
        keys, counts = np.unique(np.concatenate([key[shard.starts(lang, k + 1)] for k, key in enumerate(every)]), return_counts=True)
        counts = counts.astype("<u4")
        cuts = cuts_of(keys, parts, KEY_BITS)
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[p], cuts[p + 1])
            yield {
                "part": p, "shard": shard.row["shard"], "lang": share["lang"], "keys": packed(keys[own]),
                "counts": squeezed(counts[own].tobytes()), "below": share["below"],
            }


def _united(rows: list[dict], support: int) -> Iterator[dict]:
    """The union of the phrases frequent in some shard, less those that all shards' counts do not bring to the support, for each shard that holds them."""
    sets = [unpacked(r["keys"]) for r in rows]
    sizes = [len(x) for x in sets]
    counts = unsqueezed([r["counts"] for r in rows])
    frequent = counts > np.repeat([r["below"] for r in rows], sizes)
    _, own = np.unique(np.concatenate(sets), return_inverse=True)
    candidate = (np.bincount(own, weights=frequent) > 0) & (np.bincount(own, weights=counts) >= support)
    hit = np.split(candidate[own], np.cumsum(sizes)[:-1])
    for r, keys, chosen in zip(rows, sets, hit, strict=True):
        if chosen.any():
            yield {"shard": r["shard"], "lang": r["lang"], "part": r["part"], "keys": packed(keys[chosen])}


def _counted(shard: _Shard, told: list[dict]) -> Iterator[dict]:
    """Phase 2: the candidates' occurrences in the shard, by the phrase itself."""
    every = list(shard.keys())
    for lang in sorted({t["lang"] for t in told}):
        ranges = sorted((t["part"], t["keys"]) for t in told if t["lang"] == lang)
        wanted = np.concatenate([unpacked(keys) for _, keys in ranges])
        for k, key in enumerate(every, 1):
            starts = shard.starts(shard.row["langs"].index(lang), k)
            own = key[starts]
            at = np.searchsorted(wanted, own)
            starts = starts[wanted[np.minimum(at, len(wanted) - 1)] == own]
            first, counts = _distinct([shard.words[starts + j] for j in range(k)])
            phrases = [b" ".join([shard.vocabulary[w] for w in shard.words[s : s + k].tolist()]) for s in starts[first].tolist()]
            for phrase, n in zip(phrases, counts.tolist(), strict=True):
                yield {"lang": lang, "phrase": phrase, "f": n}


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of 32-bit columns comes first, and how often it comes."""
    number = columns[0].astype(np.uint64)
    for column in columns[1:]:
        number = (number << np.uint64(32)) | column
        number = np.unique(number, return_inverse=True)[1].astype(np.uint64)
    return np.unique(number, return_index=True, return_counts=True)[1:]


def _tables(rows: Iterator[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema=schema)


def _schema(**columns: pa.DataType) -> pa.Schema:
    return pa.schema(list(columns.items()))


_LONG, _INT, _TEXT, _BYTES = pa.int64(), pa.int32(), pa.string(), pa.binary()
_ARROW_MINED = _schema(part=_INT, shard=_LONG, lang=_TEXT, keys=_BYTES, counts=_BYTES, below=_LONG)
_ARROW_TOLD = _schema(shard=_LONG, lang=_TEXT, part=_INT, keys=_BYTES)
_ARROW_COUNTED = _schema(lang=_TEXT, phrase=_BYTES, f=_LONG)


def _each(shards: DataFrame, other: DataFrame, work, arrow: pa.Schema, schema: str, longest: int) -> DataFrame:
    """``work`` on every shard with the rows of ``other`` for it."""

    def run(shard: pa.Table, rows: pa.Table) -> pa.Table:
        told = rows.to_pylist()
        return pa.concat_tables([_tables(work(_Shard(r, longest), told), arrow) for r in shard.to_pylist() if told] or [_tables(iter(()), arrow)])

    return shards.groupBy("shard").cogroup(other.groupBy("shard")).applyInArrow(run, schema)


def _sharded(docs: DataFrame) -> DataFrame:
    d = document_columns(docs, "text", "lang").select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return staged(d.mapInArrow(_shards, _SHARD), "son-shards")


def candidates(shards: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Phase 1: per shard and lang the keys of the candidates it holds; and n per lang."""
    spark = shards.sparkSession
    sizes = shards.select("shard", F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("sizes").alias("n_shard"))))
    sizes = sizes.where("n_shard > 0")
    totals = staged(sizes.groupBy("lang").agg(F.sum("n_shard").alias("n")), "son-sizes")
    # The largest count that is not frequent at the support lowered to the shard's share.
    below = F.expr(f"CAST((CAST({support} AS DECIMAL(38,0)) * n_shard - 1) div n AS BIGINT)")
    shares = sizes.join(totals, "lang").select("shard", "lang", below.alias("below"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(tasks(spark), -(-words // GROUP_WORDS))
    mined = _each(shards, staged(shares, "son-shares"), lambda shard, rows: _mine(shard, rows, parts), _ARROW_MINED, _MINED, longest)
    union = mined.groupBy("part", "lang").applyInArrow(lambda rows: _tables(_united(rows.to_pylist(), support), _ARROW_TOLD), _TOLD)
    return staged(union, "son-candidates"), totals


def mined(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Exact counts (lang, phrase, k, f) of all phrases with f >= support, by SON; and n per lang."""
    shards = _sharded(docs)
    cands, totals = candidates(shards, support, longest)
    # Phase 2: every occurrence of a candidate counted over all documents, summed per shard before the shuffle.
    hits = _each(shards, cands, _counted, _ARROW_COUNTED, "lang string, phrase binary, f long", longest)
    exact = hits.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f")).where(F.col("f") >= support)
    exact = exact.withColumn("k", F.size(F.split("phrase", " ")))
    return staged(exact, "son-exact"), totals


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """Each lang's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score (see the module)."""
    spark = docs.sparkSession
    counts, totals = mined(docs, support, longest)
    cands = counts.where(F.col("k") >= 2).select("lang", "phrase", "k", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "k", "a", "cut",
        F.array_join(F.slice(words, 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    part = counts.select("lang", "phrase", "f")
    cuts = (
        cuts.join(part.withColumnRenamed("phrase", "left").withColumnRenamed("f", "l"), ["lang", "left"])
        .join(part.withColumnRenamed("phrase", "right").withColumnRenamed("f", "r"), ["lang", "right"])
    )
    score = F.expr(f"CAST(CAST(a AS DECIMAL(38,0)) * {SCALE} div (CAST(l AS DECIMAL(38,0)) + r) AS BIGINT)")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.score", "b.l", "b.r")
    # Shorter candidates inside longer ones, with the longer one's count.
    longer = cands.where(F.col("k") >= 3).select(
        "lang", F.col("a").alias("outer"),
        F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))).alias("phrase"),
    )
    absorbed = longer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = (
        best.join(absorbed, ["lang", "phrase"], "left")
        .where(F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * ABSORB))
        .drop("outer")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(tasks(spark)))
    first = kept.withColumn("_b", bucket).withColumn("_in", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order))).where(F.col("_in") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", F.col("a").cast("long"), F.col("l").cast("long"), F.col("r").cast("long"), F.col("n").cast("long"), F.col("score").cast("long")
    )


_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(unnest(ps), '[\x20\x09]+'), lambda w: w <> '') AS w FROM d),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
      FROM p, range(1, 5) AS kk(k), LATERAL unnest(range(1, len(w) - k + 2)) AS ii(i)),
c AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(f) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2 AND f >= {SUPPORT}),
cut AS (SELECT cand.lang, cand.phrase, a, j, cl.f AS l, cr.f AS r,
               CAST((CAST(a AS HUGEINT) * {SCALE}) // (CAST(cl.f AS HUGEINT) + cr.f) AS BIGINT) AS score
        FROM cand CROSS JOIN range(1, 4) AS jj(j)
        JOIN c cl ON cl.lang = cand.lang AND cl.phrase = array_to_string(ws[1 : j], ' ')
        JOIN c cr ON cr.lang = cand.lang AND cr.phrase = array_to_string(ws[j + 1 : cand.k], ' ')
        WHERE j < cand.k),
best AS (SELECT lang, phrase, a, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r, min(score) AS score FROM cut GROUP BY lang, phrase, a),
sub AS (SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS outer_a
        FROM cand, range(2, 4) AS mm(m), LATERAL unnest(range(1, cand.k - m + 2)) AS ii(i)
        WHERE cand.k >= 3 AND m < cand.k GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN sub USING (lang, phrase) WHERE sub.outer_a IS NULL OR sub.outer_a * 100 < best.a * {ABSORB}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase) ASC) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score
FROM ranked JOIN tot USING (lang) WHERE rank <= {TOP}
"""


@query("op11_son_collocations", _SQL)
def op11_son_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
