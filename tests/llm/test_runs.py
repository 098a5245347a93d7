"""Periodic runs by recompression against a plain search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from turnstile.llm import runs


def plain_runs(w):
    n, found = len(w), {}
    for q in range(1, n):
        t = 0
        while t + q < n:
            if w[t] != w[t + q]:
                t += 1
                continue
            s = t
            while t + q < n and w[t] == w[t + q]:
                t += 1
            if t + q - s >= max(6, 4 * q):
                found.setdefault((s, t + q - s), q)
    return sorted(((s, ln, q) for (s, ln), q in found.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    w = [x for x in re.split("[\x20\x09-\x0D]+", text or "") if x]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    rs = plain_runs(w)
    gone = [False] * len(w)
    for s, ln, q in rs:
        gone[s + q : s + ln] = [True] * (ln - q)
    best = min(rs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(rs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
        sha("".join(f"{s},{ln},{q}\n" for s, ln, q in rs)), sha(" ".join(x for x, g in zip(w, gone) if not g)),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.integers(1, 6), st.integers(0, 69))
def test_runs_against_every_period(words, p, a):
    if a < len(words):
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    assert [tuple(r) for r in runs.runs_of(np.array(words, dtype=np.int64))] == plain_runs(words)


def test_extensions_are_exact():
    r = random.Random(2)
    for _ in range(200):
        w = [r.randrange(r.choice([1, 2, 4])) for _ in range(r.randrange(2, 90))]
        g = runs.Grammar(np.array(w, dtype=np.int64))
        x = np.array([r.randrange(len(w)) for _ in range(30)])
        y = np.array([r.randrange(len(w)) for _ in range(30)])
        for xi, yi, f, b in zip(x, y, g.forward(x, y), g.backward(x, y)):
            k = 0
            while max(xi, yi) + k < len(w) and w[xi + k] == w[yi + k]:
                k += 1
            assert f == k
            k = 0
            while min(xi, yi) - k > 0 and w[xi - k - 1] == w[yi - k - 1]:
                k += 1
            assert b == k


def test_documents(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["a", "b", "c", "dd", "é"]) for _ in range(r.randrange(0, 120)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "x\ty\nx\ty\rx y x y x y"), (None, "a a a a a a a"), (203, "z " * 3_000), (3, rows[3][1])]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None)  # some tails are planted
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS collapsed", "2 AS b", "'y' AS start")
    got = sorted((tuple(x) for x in runs.periodic_runs(df).collect()), key=str)
    assert got == sorted((plain(i, t) for i, t in rows), key=str)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_very_long_text():
    w = np.array([k % 7 for k in range(100_000)] + [9] * 50_000 + list(range(50_000)), dtype=np.int64)
    assert [tuple(x) for x in runs.runs_of(w)] == [(0, 100_000, 7), (100_000, 50_000, 1)]
