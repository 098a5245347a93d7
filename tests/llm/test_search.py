"""Licence scan, decontamination and neighbours against brute force."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.llm import licences, neighbours, tiling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_places(text, base):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(own), sorted((i, label) for phrase, label in base.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("a b c d e x É".split()), max_size=40))
def test_every_place_of_a_phrase(words):
    base = {"a b": "1", "b": "2", "a b a": "3", "c c": "4", "b a b c": "5"}
    scanner = licences.Scanner(base, {"t": ["a b c d e", "b c a a"]})
    text = " ".join(words)
    n, places, _ = scanner.scan(text)
    assert (n, sorted((s, scanner.base[k][1]) for s, k in places)) == base_places(text, base)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=8), min_size=1, max_size=4), st.lists(st.sampled_from("abcx"), max_size=25))
def test_matching_statistics(templates, text):
    a = licences.Automaton([[w.encode() for w in t] for t in templates])
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    got = {at: (state, length) for at, state, length in a.statistics([w.encode() for w in text])}
    for at in range(len(text)):
        longest = max((n for n in range(1, at + 2) if tuple(text[at - n + 1 : at + 1]) in runs), default=0)
        assert got.get(at, (0, 0))[1] == longest
        if longest:  # the ends of the state's runs are those of the matched run
            run = text[at - longest + 1 : at + 1]
            assert a.ends[got[at][0]] == {(k, e) for k, t in enumerate(templates) for e in range(len(t)) if t[e - longest + 1 : e + 1] == run and e + 1 >= longest}


def test_licence_labels(spark, documents):
    texts = [
        "Released under the MIT License.", "Licensed under CC BY-NC 4.0. ALL RIGHTS  reserved", None, "", "the license of the software and the rights of the copy",
        "x " * 30_000 + "Licensed under the Apache License, Version 2.0", "GNU General Public License, version 3",
        "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files, to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ]
    got = {r.doc_id: r for r in licences.scanned(documents(texts)).collect()}
    assert got[0].labels == "mit" and got[0].n_base == 0 and got[0].first_word is None
    assert got[1].base_labels == "cc-by,reserved" and got[1].labels == "cc-by,cc-by-nc,reserved" and (got[1].first_word, got[1].last_word, got[1].n_base) == (2, 7, 2)
    for k in (2, 3):
        assert (got[k].n_words, got[k].n_base, got[k].labels, got[k].score) == (0, 0, "", 0.0)
    assert got[4].labels == "" and got[5].labels == "apache-2.0" and got[5].spans[0].first == 30_000
    assert got[6].base_labels == "gpl" and got[6].labels == "gpl,gpl-3.0"
    assert got[7].labels == "mit" and 0.75 <= got[7].score < 1
    assert licences.scanned(documents([])).count() == 0
    assert licences.scanned(documents([(None, "all rights reserved"), (None, "all rights reserved")])).count() == 2


def test_labels_that_differ_by_a_word():
    scanner = licences.Scanner()
    wanted = {
        "Licensed under CC BY 4.0": {"cc-by"}, "Creative Commons Attribution 4.0": {"cc-by"}, "Creative Commons Attribution 4.0 International License": {"cc-by"},
        "GNU General Public License, version 1": set(), "GNU General Public License, version 2": {"gpl-2.0"}, "the General Public License, version 3": {"gpl-3.0"},
        "Licensed under CC BY-SA 3.0": {"cc-by-sa"}, "Licensed under CC BY-NC-SA 4.0": {"cc-by-nc-sa"}, "Creative Commons Attribution-NoDerivatives": {"cc-by-nd"},
        "licensed under a Creative Commons Attribution-NonCommercial License": {"cc-by-nc"}, "Licensed under CC terms": set(), "CC0 1.0": {"cc0"},
        "Licensed under the Apache License, Version 1.1": set(), "Licensed under the Apache License, Version 2.0": {"apache-2.0"}, "GNU Lesser General Public License": {"lgpl"},
    }
    for text, labels in wanted.items():
        _, _, spans = scanner.scan(f"This work: {text}. End.")
        assert {s.label for s in spans} - {"gpl"} == labels, (text, spans)
    assert not any(s.label != "gpl" for s in scanner.scan("GNU General Public License, version 1")[2])


def tiled(text, item, shortest):
    """Plain greedy string tiling: compare everywhere, mark the longest, repeat."""
    free_t, free_i, covered = [True] * len(text), [True] * len(item), 0
    while True:
        best = (shortest - 1, 0, 0)
        for p in range(len(text)):
            for q in range(len(item)):
                n = 0
                while p + n < len(text) and q + n < len(item) and text[p + n] == item[q + n] and free_t[p + n] and free_i[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < shortest:
            return covered
        for k in range(n):
            free_t[p + k] = free_i[q + k] = False
        covered += n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(2, 4))
def test_tiles_against_plain_tiling(text, item, shortest):
    found = tiling.tiles(np.array(text, dtype=np.int64), np.array(item, dtype=np.int64), shortest)
    for p, q, n in found:
        assert text[p : p + n] == item[q : q + n] and n >= shortest
    assert len({p + k for p, _, n in found for k in range(n)}) == len({q + k for _, q, n in found for k in range(n)}) == sum(n for *_, n in found)
    assert [n for *_, n in found] == sorted((n for *_, n in found), reverse=True)
    assert sum(n for *_, n in found) == tiled(text, item, shortest)


def test_leaks(spark, documents):
    item = "one two three four five six seven eight nine ten eleven twelve"
    w = item.split()
    texts = [
        f"before {item} after", " ".join(["x", *w[6:], "gap", *w[:6]]), " ".join(w[:8]), None, "", "of no matter " * 9000 + item.upper(), f"{item} {item} {item}", "tiny phrase", "a tiny little phrase",
    ]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny phrase"), (5, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_tiles, r.tiled_words) for r in tiling.leaks(documents(texts), items).collect())
    assert got == [(0, 1, 1, 12), (0, 5, 1, 12), (1, 1, 2, 12), (1, 5, 2, 12), (5, 1, 1, 12), (5, 5, 1, 12), (6, 1, 1, 12), (6, 5, 1, 12), (7, 4, 1, 2)]
    kept = tiling.without_leaks(documents(texts), items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8] and kept.columns == documents(texts).columns
    blocks = tiling.leaks(documents(texts), items, block_bytes=40)
    assert sorted((r.doc_id, r.item_id, r.n_tiles, r.tiled_words) for r in blocks.collect()) == got
    assert sorted(r.doc_id for r in tiling.without_leaks(documents(texts), items, block_bytes=40).collect()) == [2, 3, 4, 8]
    assert tiling.leaks(documents([]), items).count() == 0
    assert tiling.leaks(documents(texts), items.limit(0)).count() == 0
    assert tiling.without_leaks(documents([(None, item), (None, "a"), (None, "a")]), items).count() == 2


def test_query_finds_all_items_word_by_word(spark):
    folder = "/root/testdata/sf0.001"
    try:
        docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    except Exception:
        pytest.skip("no test tables")
    clean = lambda t: re.sub("[^a-z0-9_\x80-\U0010ffff]+", " ", (t or "").lower()).strip()
    wanted = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if f" {clean(i.text)} " in f" {clean(d.text)} "}
    got = {(r.doc_id, r.item_id) for r in tiling.op2(spark, folder).collect()}
    assert wanted and wanted <= got


def test_neighbours_against_brute_force(spark):
    r = np.random.default_rng(3)
    vectors = [(i, r.normal(size=16).tolist()) for i in range(300)]
    vectors += [(300, None), (301, [0.0] * 16), (302, [math.nan] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, [math.inf] + [1.0] * 15), (305, []), (None, [1.0] * 16)]
    vectors += [(400 + i, vectors[10][1]) for i in range(7)] + [(20, vectors[20][1]), (500, [1e30 * x for x in vectors[30][1]]), (510, [1e-30 * x for x in vectors[40][1]])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, rank string, a int")
    got = neighbours.nearest(df, "vec_id", "embedding", F.pmod("id", F.lit(10)) == 0, 5).collect()
    ok = {i: np.array(v) for i, v in vectors if i is not None and (i < 300 or i >= 400)}
    cos = lambda x, y: float((x / abs(x).max()) @ (y / abs(y).max()) / np.linalg.norm(x / abs(x).max()) / np.linalg.norm(y / abs(y).max()))
    found = {}
    for row in got:
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert set(found) == {i for i in ok if i % 10 == 0}
    for q, rows in found.items():
        best = sorted((-round(cos(ok[q], v), 12), i) for i, v in ok.items() if i != q)[:5]
        assert [(k, i) for k, i, _ in sorted(rows)] == [(k + 1, i) for k, (_, i) in enumerate(best)], q
        assert np.allclose([s for *_, s in sorted(rows)], [-s for s, _ in best], atol=1e-9)
    few = neighbours.nearest(df.where("vec_id < 3"), "vec_id", "embedding", F.pmod("id", F.lit(10)) == 0, 5)
    assert few.count() == 2
    assert neighbours.nearest(df.limit(0), "vec_id", "embedding", F.lit(True), 5).count() == 0


def test_neighbours_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES_IN_BLOCK", 40)
    monkeypatch.setattr(neighbours, "QUERIES_IN_BLOCK", 7)
    r = random.Random(5)
    df = spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(200)], "vec_id long, embedding array<float>")
    wanted = neighbours.nearest(df, "vec_id", "embedding", F.pmod("id", F.lit(5)) == 0, 4).orderBy("query_id", "rank").collect()
    monkeypatch.undo()
    assert wanted == neighbours.nearest(df, "vec_id", "embedding", F.pmod("id", F.lit(5)) == 0, 4).orderBy("query_id", "rank").collect()
    assert len(wanted) == 160
