"""Substring dedup by doubling against all windows compared in plain Python."""

import hashlib
import random
import re

import numpy as np

from turnstile.llm import substrings


def plain(rows, window=20):
    """rows: (doc_id, text); per row (doc_id, n_words, n_removed, kept_sha256)."""
    docs = [(i, t, [w for w in re.split("[\x20\x09-\x0D]+", t or "") if w]) for i, t in rows]
    first = {}
    for i, t, w in docs:
        for s in range(len(w) - window + 1):
            place = ((i is not None, i), hash(t), s)
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, place), place)
    out = []
    for i, t, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < ((i is not None, i), hash(t), s):
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    return df.selectExpr("*", "1 AS start", "'x' AS sub", "2 AS h1", "'y' AS starts")


def result(spark, rows, **kw):
    got = [tuple(r) for r in substrings.deduplicated(frame(spark, rows), **kw).collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r))


def test_against_all_windows(spark):
    r = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for i in range(40):
        words = [f"w{r.randrange(6)}" for _ in range(r.randrange(0, 80))]
        if i % 3 == 0:
            at = r.randrange(len(words) + 1)
            words[at:at] = passage.split()[r.randrange(5) :]
        rows.append((i, "\t".join(words) if i % 7 == 0 else " ".join(words)))
    rows += [(100, None), (101, ""), (102, passage + " " + passage), (103, "x " * 50)]
    assert result(spark, rows) == plain(rows)


def test_window_of_other_sizes(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(30)))) for i in range(30)]
    assert result(spark, rows, window=8, base=2) == plain(rows, 8)


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(f"q{k}" for k in range(25))
    rows = [(1, text), (1, text), (None, text), (0, text + " tail"), (2, "short text")]
    got = result(spark, rows)
    assert got == plain(rows)
    assert [g[2] for g in got if g[0] == 1] == [25, 25]  # the row with no id is first
    assert result(spark, []) == []


def test_very_long_text(spark):
    long = " ".join(f"v{k % 1000}" for k in range(40_000))
    got = result(spark, [(7, long)])
    assert got == plain([(7, long)])
    assert got[0][2] == 39_000


def test_keys_move_in_few_bytes():
    # Before, each window moved a key of 16 bytes at every level.
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << substrings.KEY_BITS, 1 << 18).astype(np.uint64))
    blob = substrings.packed(keys)
    assert len(blob) < 3.5 * len(keys)
    assert np.array_equal(substrings.unpacked(blob), keys)


def test_passage_of_many_blocks_and_equal_places(spark):
    passage = " ".join(f"s{k}" for k in range(24))
    rows = [(i // 2, f"{passage} own{i % 4}") for i in range(60)] + [(None, passage), (None, passage), (-1, f"x {passage}")]
    df = frame(spark, rows).repartition(7)
    got = sorted([tuple(r) for r in substrings.deduplicated(df).collect()], key=lambda r: (r[0] is not None, r))
    assert [r[:3] for r in got[:3]] == [(None, 24, 0), (None, 24, 0), (-1, 25, 24)]
    assert {r[1] - r[2] for r in got[3:]} <= {0, 1}
    later = substrings.later_starts(df).collect()
    assert len({(r.doc_id, r["sub"]) for r in later}) == 61 and {r.start for r in later if r.doc_id == -1} == set(range(1, 6))


def test_first_level_moves_no_block(spark, monkeypatch):
    # Before, the blocks were shuffled and sorted at the first level too, though no answers wait for them there.
    moved = []
    each = substrings._each
    monkeypatch.setattr(substrings, "_each", lambda *a, **kw: moved.append(kw.get("schema") or a[3]) or each(*a, **kw))
    rows = [(i, " ".join(f"m{k}" for k in range(22))) for i in range(6)]
    assert result(spark, rows) == plain(rows)
    assert len(moved) == 3 and moved.count(substrings._KEYS) == 1
