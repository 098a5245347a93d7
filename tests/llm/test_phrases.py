"""Collocations by SON against a plain count of all phrases."""

import random
import re
from collections import Counter

from turnstile.llm import collocations


def plain(rows, support, top):
    """rows: (text, lang) pairs; the contract in plain Python."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= support}
    out = []
    for (lang, ph), a in cands.items():
        cuts = [((2_000_000 * a) // (f[lang, ph[:k]] + f[lang, ph[k:]]), k) for k in range(1, len(ph))]
        score, k = min(cuts)
        inside = [b for (lg, q), b in cands.items() if lg == lang and len(q) > len(ph) and any(q[i : i + len(ph)] == ph for i in range(len(q) - len(ph) + 1)) and 100 * b >= 80 * a]
        if not inside:
            out.append((lang, " ".join(ph), a, f[lang, ph[:k]], f[lang, ph[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(ranked)


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, g, "s") for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "'x' AS phrase", "'y' AS shard", "1 AS f", "2 AS k")


def test_against_plain_count(spark):
    r = random.Random(3)
    vocab = ["a", "b", "c", "The", "déjà", "x\ty", "e"]
    rows = []
    for _ in range(60):
        words = [r.choice(vocab) + r.choice(["", "", ".", ",", "\n", " ", "!"]) for _ in range(r.randrange(0, 40))]
        rows.append((" ".join(words), r.choice(["en", "de", None])))
    rows += [(None, "en"), ("", None), ("A B A B A B A B " * 300, "fr")] * 2
    got = collocations.collocations(frame(spark, rows), support=5, top=7)
    have = sorted(tuple(x) for x in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert have == plain(rows, 5, 7)
    assert have  # the fixture has candidates in every lang


def test_empty_and_no_candidates(spark):
    assert collocations.collocations(frame(spark, []), support=2).count() == 0
    assert collocations.collocations(frame(spark, [("one two", "en"), (None, None)]), support=2).count() == 0


def test_ties_and_absorption(spark):
    # "p q" and "q r" only ever stand inside "p q r": absorbed; "s t" and "u v" tie on score and a, phrase order decides.
    rows = [("p q r. s t. u v", "en")] * 4
    got = collocations.collocations(frame(spark, rows), support=4, top=10).collect()
    assert [(x.rank, x.phrase) for x in sorted(got, key=lambda x: x.rank)] == [(1, "p q r"), (2, "s t"), (3, "u v")]
    assert sorted(tuple(x) for x in got) == plain(rows, 4, 10)


def test_counts_move_once_a_shard_and_candidates_reach_every_shard(spark):
    # Eight shards: seven hold "rare pair" once, so it is frequent in no shard but by its lowered support; one holds it twice.
    rows = [("rare pair. " + " ".join(f"z{i}x{k}" for k in range(40)), "en") for i in range(7)] + [("rare pair, rare pair", "en")]
    df = frame(spark, rows).repartition(8)
    shards = collocations._sharded(df)
    told, _ = collocations.candidates(shards, support=9)
    # Before, each phrase was a row of its own: here 8 documents have more than 1,000 phrases.
    held = sum(len(collocations.unpacked(r["keys"])) for r in told.collect())
    assert held == 3 * shards.count()  # "rare", "pair" and "rare pair", each told to all shards
    got = collocations.collocations(df, support=9, top=10)
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, 9, 10)
