"""Shuffle, near copies, quality, pseudonyms, chats and the pipeline."""

import hashlib
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from turnstile.llm import chat, graph, near_copies, pseudonyms, quality, shuffle
from turnstile.llm.words import words

FOLDER = "/root/testdata/sf0.001"


def tables(name):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return f"{FOLDER}/{name}.parquet"


# Shuffle


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 50, 97, 1000])
def test_places_are_a_permutation(spark, n):
    rows = spark.range(n).select(shuffle.permuted(F.col("id"), n, seed=5).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))


def test_shards(spark, documents):
    rows = [(i % 5 if i % 3 else None, f"t{i % 4}") for i in range(101)]
    placed = shuffle.place_rows(documents(rows).drop("shard"), ["doc_id", "text"], 7, seed=1).cache()
    by_shard = {}
    for r in placed.collect():
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert sorted(by_shard) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert {len(s) for s in by_shard.values()} <= {14, 15}
    assert Counter((r.doc_id, r.text) for r in placed.collect()) == Counter(rows)
    numbers = [(r.doc_id is not None, r.doc_id, r.text) for r in placed.orderBy("row_number").collect()]
    assert numbers == sorted(numbers, key=lambda t: (t[0], t[1] or 0, t[2]))
    again = shuffle.place_rows(spark.range(60), ["id"], 7, seed=1).orderBy("id").collect()
    assert again == shuffle.place_rows(spark.range(60).repartition(13), ["id"], 7, seed=1).orderBy("id").collect()
    assert shuffle.place_rows(spark.range(0), ["id"], 7, seed=1).count() == 0


# Near copies


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long") if edges else spark.createDataFrame([], "a long, b long")
    root = {n: n for e in edges for n in e}
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    want = {n: r for n, r in root.items() if any(a != b and n in (a, b) for a, b in edges)}
    if len(edges) % 4 == 0:  # every fourth, as each runs several jobs
        assert {r.node: r.root for r in graph.components(df).collect()} == want


def brute_links(texts):
    sets = {}
    for i, t in texts:
        w = words(t)
        n = min(5, len(w))
        sets.setdefault(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if n else frozenset(), []).append(i)
    keys = list(sets)
    links = {k: [o for o in keys if o is not k and k and o and len(k & o) >= 0.8 * len(k | o)] for k in keys}
    out = {}
    for k in keys:
        seen, todo = {k}, [k]
        while todo:
            for o in links[todo.pop()]:
                if o not in seen:
                    seen.add(o)
                    todo.append(o)
        for i in sets[k]:
            out[i] = (min(min(sets[o]) for o in seen), min(sets[k]), len(links[k]))
    return out


def near(text, r, changes):
    own = text.split()
    for _ in range(changes):
        own[r.randrange(len(own))] = f"n{r.randrange(10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("few,block", [(8, 128), (2, 7), (3, 16)])
def test_links_against_brute_force(spark, documents, prose, monkeypatch, few, block):
    monkeypatch.setattr(near_copies, "FEW", few)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    r = random.Random(few)
    base = prose(20, 80, seed=few)
    texts = list(base) + [near(base[0], r, r.randrange(4)) for _ in range(60)] + [near(base[k % 5], r, r.randrange(5)) for k in range(40)] + [base[1]] * 30
    texts += ["", None, "  ...", "one two", "one two", "One  TWO!", "a b c d e", "a b c d f", "x " * 3000, base[2].upper().replace(" ", ", ")]
    got = {row.doc_id: (row.class_id, row.text_id, row.n_links) for row in near_copies.linked(documents(texts), recall=0.9999999).collect()}
    assert got == brute_links(list(enumerate(texts)))


def test_one_of_each(spark, documents, prose):
    a, b, c = prose(3, 50, seed=9)
    rows = [(3, a), (1, a + " more"), (None, b), (5, b), (7, c), (7, c), (8, None), (9, ""), (2, a)]
    kept = near_copies.one_of_each(documents(rows))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("1", a + " more"), ("None", b), ("7", c), ("8", None)])
    assert kept.columns == documents(rows).columns
    assert near_copies.one_of_each(documents([])).count() == 0
    assert near_copies.linked(documents([])).count() == 0


def test_settled_components_take_no_further_round(spark, monkeypatch):
    # Before, a star was found settled only after a whole round more: five staged results before the roots.
    made = []
    staged = graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, label: made.append(label) or staged(df, label))
    edges = spark.createDataFrame([(k, 1) for k in range(2, 30)] * 2 + [(41, 40)], "a long, b long")
    assert {r.node: r.root for r in graph.components(edges).collect()} == {**{k: 1 for k in range(1, 30)}, 40: 40, 41: 40}
    assert made == ["edges", "components"]


def test_pairs_met_before_are_not_compared_again(monkeypatch):
    # Before, the shingles of a cell were compared even if all its pairs had met under an earlier value.
    shingles = np.arange(50, dtype=np.uint64)
    rows = [{"set_id": i, "block": 0, "left": 0, "right": 0, "band": 1, "bands": np.array([7 if i < 3 else i, 9]), "shingles": shingles[i:].tobytes()} for i in range(4)]
    compared = []
    similar = near_copies._similar_pairs
    monkeypatch.setattr(near_copies, "_similar_pairs", lambda sets, similarity: compared.append(len(sets)) or similar(sets, similarity))
    assert near_copies.compare_blocks(pd.DataFrame(rows[:3]), 0.8).empty and not compared
    got = near_copies.compare_blocks(pd.DataFrame(rows), 0.8)
    assert sorted(zip(got["a"], got["b"], got["links"])) == [(0, 0, 1), (1, 0, 1), (2, 0, 1), (3, 0, 3)] and compared == [4]


def test_bands_reach_the_recall():
    for rows in (3, 7):
        bands = near_copies.bands_for(0.8, 0.999, rows)
        miss = lambda b: (1 - 0.8**rows) ** b
        assert miss(bands.bands) <= 0.001 < miss(bands.bands - 1)


# Quality


def test_hinge_fit_parts_what_can_be_parted():
    r = np.random.default_rng(0)
    rows = [np.unique(np.concatenate((r.integers(100, 900, 20), [1 if k % 2 else 2]))) for k in range(400)]
    good = np.arange(400) % 2.0
    scale = quality.log_count_ratios(rows, good)
    w, b = quality.hinge_fit(rows, good, scale)
    assert ((quality.margins(rows, w, b, scale) > 0) == (good > 0.5)).all()


def test_hinge_fit_is_optimal():
    """Dual coordinate descent against projected gradient descent on the same dual."""
    r = np.random.default_rng(1)
    rows = [np.unique(r.integers(0, 12, 4)) for _ in range(30)]
    good = r.integers(0, 2, 30).astype(float)
    scale = quality.log_count_ratios(rows, good)
    w, b = quality.hinge_fit(rows, good, scale)
    y = np.where(good > 0.5, 1.0, -1.0)
    x = np.zeros((30, 13))
    for i, row in enumerate(rows):
        x[i, row] = scale[row] / np.sqrt((scale[row] ** 2).sum() + 1e-12)
    x[:, 12] = 1
    cost = quality.COST * 30 / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha = np.zeros(30)
    for _ in range(20_000):
        alpha = np.clip(alpha - 0.01 * (q @ alpha - 1), 0, cost)
    assert np.allclose(np.append(w[:12], b), (alpha * y) @ x, atol=0.02)


def test_held_out_quality(spark):
    tables("documents")
    got = quality.op6(spark, FOLDER.replace("0.001", "0.01")).toPandas().merge(pd.read_parquet(f"{FOLDER.replace('0.001', '0.01')}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_quality_of_odd_rows(spark, documents):
    texts = ["good plain words here"] * 30 + ["BAD!! BAD!! BAD!!"] * 30 + [None, "", "bad!! " * 40_000]
    labels = [(i, int(i < 30), 0) for i in range(60)] + [(None, 1, 0), (3, 1, 0), (4, 0, 0), (61, None, 0)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    got = {r.doc_id: r.score for r in quality.scored(documents(texts), frame).collect()}
    assert len(got) == 63 and all(0 <= s <= 1 for s in got.values())
    assert got[60] == got[61] and min(got[i] for i in range(30)) > max(got[i] for i in range(30, 60))
    kept = quality.accepted(documents(texts), frame)
    assert {r.doc_id for r in kept.collect()} >= set(range(30)) and kept.columns == documents(texts).columns
    assert {r.score for r in quality.scored(documents(texts), frame.limit(0)).collect()} == {0.5}
    assert quality.scored(documents([]), frame).count() == 0


# Pseudonyms


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms(spark, documents):
    texts = [
        "Pay 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112. +1 (017) 555-7713 x", "mail Jo.doe23@mail3.example.com ip 176.198.137.143 v1.2.3.4.5 999.1.1.1",
        None, "", "GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, GB83 WEST 1234 5698 7654 32", "123-45-6789 000-12-3456 1999-02-28 31.12.2020 05/06/1980 31/02/2020 1650-01-01",
        'token = "908038b7da908038b7da" 4111111111111111!! TOKEN = "9233A8ECF7C5B09F"', "clean text, 12 apples in 2020.", "word " * 30_000 + "4111111111111111",
    ]
    docs = documents(texts)
    out = {r.doc_id: r for r in pseudonyms.pseudonymized(docs, "k", count="changed").collect()}
    assert [out[i].changed for i in range(9)] == [3, 2, 0, 0, 2, 4, 3, 0, 1]
    assert out[2].text is None and out[3].text == "" and out[7].text == texts[7] and out[0].lang == "en" and out[0].ids == "x"
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
    for i in (0, 4, 5):
        assert shape(out[i].text) == shape(texts[i])
    spaced, plain = re.search(r"Pay ([\d ]{19}) or (\d{16}), not 4111111111111112\.", out[0].text).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111" and luhn(plain) and plain[0] == "4"
    assert plain in out[6].text and plain in out[8].text and "4111111111111111" not in out[8].text
    assert "@mail3.example.com" in out[1].text and "Jo.doe23" not in out[1].text and "v1.2.3.4.5 999.1.1.1" in out[1].text and "176.198.137.143" not in out[1].text
    assert "GB83 WEST 1234 5698 7654 32" in out[4].text and "DE89370400440532013000" not in out[4].text
    assert "000-12-3456" in out[5].text and "31/02/2020 1650-01-01" in out[5].text and "1999-02-28" not in out[5].text
    again = pseudonyms.pseudonymized(spark.createDataFrame([(i, r.text) for i, r in out.items()], "doc_id long, text string"), "k", count="changed")
    assert [r.changed for r in again.orderBy("doc_id").collect()] == [3, 2, 0, 0, 2, 4, 3, 0, 1]  # every pseudonym stands the check of its kind
    other = pseudonyms.pseudonymized(docs, "other key").where("doc_id = 0").first().text
    assert other != out[0].text
    assert pseudonyms.pseudonymized(documents([]), "k").count() == 0


def test_numbers_beside_a_find_do_not_hide_it(spark, documents):
    spaced, plain, spanish = "4111 1111 1111 1111", "4111111111111111", "ES91 2100 0418 4502 0005 1332"
    texts = [
        f"{spaced} 12/27", f"{plain} 123", f"7 {plain}", f"{spanish} EUR", f"{spanish.replace(' ', '')} EUR", "BE68 5390 0754 7034 EUR 100", f"1234 5678 {spaced}",
        f"{spaced} 123-45-6789", f"{spanish} {spaced}", f"+1 212 555 0123 {spaced}", f"+44 20 7946 0958 {spaced}", f"{spaced} {spaced}", f"AT12 1234 {spaced}", f"{spanish} JOE@mail.com", f"+{plain}",
    ]
    clear = [spaced, plain, "123-45-6789", spanish, spanish.replace(" ", ""), "BE68 5390 0754 7034", "JOE@", "+1 212 555 0123", "+44 20 7946 0958"]
    got = pseudonyms.pseudonymized(documents(texts), "k", count="changed").orderBy("doc_id").collect()
    for r, text in zip(got, texts, strict=True):
        assert len(r.text) == len(text) and not [c for c in clear if c in r.text], (text, r.text)
    assert [r.changed for r in got] == [1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 1, 2, 1]
    assert got[0].text.endswith(" 12/27") and got[1].text.endswith(" 123") and got[2].text.startswith("7 ") and got[3].text.endswith(" EUR") and got[5].text.endswith(" EUR 100")
    assert len({re.search(r"4[0-9 ]{15,18}$", got[i].text).group().replace(" ", "") for i in (2, 6, 8, 9, 10)}) == 1


def test_different_values_stay_different(spark):
    day = F.date_add(F.lit("1700-01-01").cast("date"), F.col("id").cast("int"))
    days = spark.range(0, 146_097, 37).select(F.date_format(day, "yyyy-MM-dd").alias("text"))
    got = pseudonyms.pseudonymized(days, "k")
    assert got.distinct().count() == days.count() and got.where("text not between '1700-01-01' and '2099-12-31'").count() == 0
    numbers = spark.range(2000).select(F.format_string("+44 20 7%07d", "id").alias("text"))
    assert pseudonyms.pseudonymized(numbers, "k").distinct().count() == 2000
    ssn = spark.range(2000).select(F.format_string("%03d-%02d-%04d", F.col("id") % 665 + 1, F.col("id") % 99 + 1, F.col("id") + 1).alias("text"))
    got = pseudonyms.pseudonymized(ssn, "k", count="n")
    assert got.select("text").distinct().count() == 2000 and got.where("n <> 1").count() == 0


# Chats


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>", "\\", "[", "<", "a", " ", "\n", "[\\INST]", "é"]), max_size=8))
def test_control_strings_are_escaped_reversibly(parts):
    text = "".join(parts)
    escaped = re.sub(chat.CONTROL, lambda m: "\\" + m.group(), text)
    assert chat.ESCAPED.sub("", escaped) == text
    assert not any(c in escaped for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"))


def test_conversations_against_plain_python(spark):
    texts = ["</s>[INST] ok [/INST]", None, "", "<\\s> [\\\\INST] é😀", "plain", "<|user|> \\", "x" * 100_000]
    roles = ["user", "assistant", "system", None, "tool|<s> é", "assistant"]
    r = random.Random(2)
    rows = [(c if c else None, r.choice([0, 1, 2, 3, None]), r.choice(roles), r.choice(texts)) for c in range(6) for _ in range(r.choice([1, 5, 12]))]
    rows += [(77, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(70)] + rows[:3]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("clash"))
    nodes = chat.chained(df.drop("node"), "conv_id", ["turn", "role", "text"])
    nodes = nodes.select("tree", "node", "parent", F.lit(0.0).alias("score"), F.col("conv_id").alias("conv"), "role", "text")
    got = {x.conv_id: x for x in chat.digests(chat.conversations(nodes)).collect()}
    first = lambda v: (v is not None, v if v is not None else 0)
    want = {}
    for c, t, role, text in sorted(rows, key=lambda x: (first(x[1]), (x[2] is not None, x[2] or ""), (x[3] is not None, x[3] or ""))):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        x, loss = got[c], "".join(t for role, t in turns if role == "assistant")
        assert (x.n_turns, x.loss_chars) == (len(turns), len(loss))
        assert x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert x.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.conversations(nodes.limit(0))).count() == 0


def test_best_branches(spark):
    #        1
    #      2   3          best leaf of tree 1: 4 (mean 3), then 6 (mean 2), then 5
    #     4 5   6   and 7 is a tree whose parent is not stored
    nodes = spark.createDataFrame([(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 1.0), (1, 4, 2, 8.0), (1, 5, 2, None), (1, 6, 3, 5.0), (2, 7, 99, 1.0)], "tree long, node long, parent long, score double")
    got = {}
    for r in chat.paths(nodes, keep=2).collect():
        got.setdefault((r.tree, r.leaf), []).append((r.place, r.node))
    assert {k: sorted(v) for k, v in got.items()} == {(1, 4): [(0, 1), (1, 2), (2, 4)], (1, 6): [(0, 1), (1, 3), (2, 6)], (2, 7): [(0, 7)]}
    chain = spark.range(100).select(F.lit(1).cast("long").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"))
    assert [(r.place, r.node) for r in chat.paths(chain).orderBy("place").collect()] == [(i, i) for i in range(100)]
    with pytest.raises(ValueError, match="cycle"):
        chat.paths(spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], "tree long, node long, parent long, score double"))


# Queries with SQL, and the pipeline


@pytest.mark.parametrize("name", ["op8_ngram_join", "op10_reply_trees"])
def test_query_equals_sql(spark, name):
    from turnstile.llm.registry import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables(t)}'")
    df = QUERIES[name](spark, FOLDER)
    want = con.execute(ORACLES[name]).df()[sorted(df.columns)]
    assert sorted(map(tuple, df.select(*sorted(df.columns)).collect())) == sorted(want.itertuples(index=False, name=None))


def test_pipeline(spark):
    tables("documents")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, docs, FOLDER).cache()
        if name != "packing":
            assert kept[name].columns == docs.columns
        docs = kept[name]
    ids = {k: {r.doc_id for r in v.select("doc_id").collect()} for k, v in kept.items() if k != "packing"}
    before = {r.doc_id: r.text for r in kept["start"].collect()}
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet").set_index("doc_id").quality
    assert np.mean([labels[i] for i in ids["quality"] if i in labels]) > 0.97
    assert np.mean([labels[i] == 0 for i in ids["start"] - ids["quality"] if i in labels]) > 0.9
    classes = brute_links([(i, before[i]) for i in ids["quality"]])
    assert ids["near_copies"] == {c for c, *_ in classes.values()}
    assert ids["decontamination"] <= ids["near_copies"] and ids["personal_data"] == ids["decontamination"]
    items = [" ".join(map(bytes.decode, words(t))) for t in pd.read_parquet(f"{FOLDER}/benchmark.parquet").text]
    for i in ids["near_copies"]:
        held = any(x in " ".join(map(bytes.decode, words(before[i]))) for x in items)
        assert not (held and i in ids["decontamination"])
    after = {r.doc_id: r.text for r in kept["personal_data"].collect()}
    assert all(len(after[i]) > 0 for i in after) and any(after[i] != before[i] for i in after)
    packed = kept["packing"].collect()
    assert {p.doc_id for r in packed for p in r.parts} == ids["personal_data"] and max(r.n_tokens for r in packed) <= 2048
    assert corpus_pipeline.run(spark, FOLDER).count() == len(packed)
