import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnstile.llm import packing, token_files, tokens

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    " a  b", "a \n b", "a\n b \n\nc", "  a", "a ", "a\n ", "a\xa0 b", "x　y  z", "ΣΑΣ Σ ὈΔ", "é ́e", "a\x1cb", "don't DON'T I'll",
    "日本語 テスト ４５", "<|endoftext|> a<|endoftext|>", "\t\ta \t b", " ", "\n", "a\r\n b", "1 2 ³½ 12345", "a,\nb.\n\nc_, d), e.. f",
    "x" * 100 + " y," * 60 + "\nZ", "a\u0085 b.\u0085c", "İSTANBUL ǅ ß ẞ", "", "\x00 \x01 a", "😀 👩‍👩‍👧 a😀.", "ﬁ ﬁle",
]


def plain(file):
    t = Tokenizer.from_file(public_tokenizers.path(file))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", FILES)
def test_ids_are_those_of_whole_texts(file):
    own, whole = tokens.Encoder(public_tokenizers.path(file)), plain(file)
    for _ in range(2):
        for text, ids in zip(ODD, own.encode(ODD), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


def test_words_met_once_are_not_kept():
    own, whole = tokens.Encoder(public_tokenizers.path(FILES[0])), plain(FILES[0])
    texts = [" ".join(f"again u{k:05x}{n:05x}" for k in range(50)) for n in range(40)]
    for text in texts:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == whole(text)
    assert any(w.strip("\x00") == "again" for w in own.young) and len(own.young) < 200


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé ÉΣ  \n\t.,'s1_-\x1ćŵ日"), max_size=30), max_size=4))
def test_ids_of_any_text(file, texts):
    own, whole = tokens.encoder(public_tokenizers.path(file)), plain(file)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [whole(t) for t in texts]


@pytest.mark.parametrize("file", FILES)
def test_ids_are_those_of_the_unswitched_tokenizer(spark, documents, file):
    path = public_tokenizers.path(file)
    t = Tokenizer.from_file(path)
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "<|startoftext|> x  <|startoftext|>", "<|ENDOFTEXT|> a", "<|endoftext| > a", "H\u0331am T\u0308 J\u030c", "h\u0331am", "plain E\u0301 text", "ΣΑΣ", ""]
    texts += [a + b for a in ("H", "T", "W", "Y", "A", "J", "I", "Σ", "Ω", " ") for b in ("\u0331", "\u0308", "\u030a", "\u02be", "\u030c", "\u0307", "\u0345\u0301")]
    want = [t.encode(text, add_special_tokens=False).ids for text in texts]
    own = tokens.encoder(path)
    for _ in range(2):
        for text, ids, ok in zip(texts, own.encode(texts), want, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ok, repr(text)
    assert 1 < len(texts) and t.token_to_id("<|endoftext|>") in want[1]
    rows = packing.pieces_of(documents(texts), path, 0, 2048, keep_ids=True).collect()
    assert {r.doc_id: token_files.unsqueezed([r.ids]).tolist() for r in rows} == {i: [*ok, 0] for i, ok in enumerate(want)}


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(FILES), st.lists(st.text(alphabet=st.sampled_from("aHTJÉ \n.'1\u0331\u0308\u030c\u0301") | st.sampled_from(["<|endoftext|>", "<|startoftext|>"]).flatmap(st.sampled_from), max_size=20), max_size=4))
def test_ids_of_texts_with_marks(file, texts):
    path = public_tokenizers.path(file)
    t = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder(path).encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    own, whole = tokens.Encoder(public_tokenizers.path(FILES[0])), plain(FILES[0])
    texts = [" ".join(f"word{k}x{i}" for k in range(20)) for i in range(30)]
    for i in range(0, 30, 3):
        for text, ids in zip(texts[i : i + 3], own.encode(texts[i : i + 3]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole(text)
    assert len(own.young) <= 50 + 3 * 60


@pytest.mark.parametrize("file", FILES)
def test_letters_between_signs_are_cut_without_the_pattern(file, monkeypatch):
    own, whole = tokens.Encoder(public_tokenizers.path(file)), plain(file)
    words = ["wort.", "(wort)", "wort###", "«wort", "_wort_", "wörter!?", "wort\x01.", "wort'.", "'wort", "wo-rt", "wort2.", "...", "wort\n"]
    texts = [f"{a} {b}{c}" for a in words for b in words for c in ("", " ")]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [whole(x) for x in texts]
    by_pattern = {word: tokens.Encoder._RUNS.findall(word) for word in ("wort.", "(wort)", "wort###", "_wort_", "wörter!?")}

    class Unused:
        def findall(self, word):
            raise AssertionError(f"the pattern was asked for {word}")

    monkeypatch.setattr(tokens.Encoder, "_RUNS", Unused())
    assert {word: own._runs(word) for word in by_pattern} == by_pattern


def test_lower_case_ascii_words_are_not_normalized_again(monkeypatch):
    # Before, each new word of a lower-cased text was lower-cased again, and one between signs became a list of runs first.
    own, whole = tokens.Encoder(public_tokenizers.path(FILES[0])), plain(FILES[0])
    text = "wort (wort) wort, --wort!! Wort2 a'b x.y 12 ... wortwort(wort)"
    asked = []
    monkeypatch.setattr(tokens.Encoder, "_plain", lambda self, word: asked.append(word) or word == word.lower())
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == whole(text)
    assert set(asked) == {"12", "..."}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=9), min_size=1, max_size=5))
def test_values_come_back(runs):
    counts = np.array([len(r) for r in runs], dtype=np.int64)
    values = np.array([v for r in runs for v in r], dtype="<u4")
    control, data = token_files.encode_values(values, counts)
    assert token_files.decode_values(control, data, counts).tolist() == values.tolist()
    assert [len(c) for c in control] == [-(-n // 4) for n in counts.tolist()]


def test_token_files(spark, documents, tmp_path):
    rows = [(7, "the cat the cat"), (3, None), (5, ""), (5, "a"), (None, "the"), (1, "the end " * 3000), (7, "the cat the cat")]
    files = token_files.write_token_files(documents(rows), public_tokenizers.path(FILES[0]), 2, str(tmp_path / "t"))
    read = token_files.with_starts(token_files.decoded(files), files.documents).orderBy("start").collect()
    whole = plain(FILES[0])
    assert [r.doc_id for r in read] == [None, 1, 3, 5, 5, 7, 7]
    want = {i: {tuple(whole(t) + [2]) for j, t in rows if i == j} for i, _ in rows}
    at = 0
    for r in read:
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert ids in want[r.doc_id] and r.start == at and r.n_tokens == len(ids)
        at += len(ids)
    counts = np.bincount(np.concatenate([np.frombuffer(r.ids, "<u4") for r in read]))
    assert (np.diff(counts[files.by_rank]) <= 0).all() and len(files.by_rank) == (counts > 0).sum()


def test_token_files_of_nothing(spark, documents, tmp_path):
    files = token_files.write_token_files(documents([]), public_tokenizers.path(FILES[0]), 2, str(tmp_path / "t"))
    assert token_files.with_starts(token_files.decoded(files), files.documents).count() == 0


def packed_well(rows, capacity):
    by_bin = {}
    for length, b, offset in rows:
        by_bin.setdefault(b, []).append((offset, length))
    for own in by_bin.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(own) <= capacity.documents and sum(n * n for _, n in own) <= capacity.attention
    return len(by_bin)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80), st.integers(1, 8), st.integers(10_000, 12_000))
def test_best_fit_keeps_every_capacity(rule, lengths, documents, attention):
    capacity = packing.Capacity(100, documents, attention, rule=rule)
    bins, offsets = packing.best_fit(np.array(lengths, dtype=np.int64), capacity)
    packed_well(zip(lengths, bins.tolist(), offsets.tolist(), strict=True), capacity)


def test_short_pieces_fill_the_sequences_of_the_queries():
    bins, _ = packing.best_fit(np.ones(4096, dtype=np.int64), packing.SEQUENCES)
    assert len(set(bins.tolist())) == 2


def test_best_fit_is_close_to_the_bound():
    lengths = np.random.default_rng(1).integers(1, 1500, 5000)
    bins, _ = packing.best_fit(lengths, packing.Capacity())
    assert len(set(bins.tolist())) <= 1.01 * lengths.sum() / 2048 + 1


def test_pieces_and_sequences(spark, documents):
    rows = [(1, "a b c " * 3000), (2, None), (2, ""), (None, "short"), (4, "short"), (4, "short")]
    path, whole = public_tokenizers.path(FILES[1]), plain(FILES[1])
    pieces = packing.pieces_of(documents(rows), path, 0, 2048, keep_ids=True)
    packed = packing.pack(pieces).cache()
    got = packed.collect()
    packed_well([(r.length, r.sequence_id, r.offset) for r in got], packing.Capacity())
    long = sorted((r for r in got if r.doc_id == 1), key=lambda r: r.piece)
    ids = token_files.unsqueezed([r.ids for r in long]).tolist()
    assert ids == whole(rows[0][1]) + [0]
    assert [r.length for r in long[1:]] == [2048] * (len(long) - 1) and [r.start for r in long] == np.cumsum([0, *[r.length for r in long[:-1]]]).tolist()
    assert all(r.ids_crc32 == zlib.crc32(token_files.unsqueezed([r.ids]).tobytes()) for r in got)
    assert sorted(str(r.doc_id) for r in got if r.doc_id != 1) == sorted(str(i) for i, _ in rows[1:])
    laid = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in laid) == 4 * sum(r.length for r in got) == 4 * sum(r.n_tokens for r in laid)
    for r in laid:
        for p in r.parts:
            own = next(x for x in got if (x.sequence_id, x.offset) == (r.sequence_id, p.offset))
            assert bytes(r.ids)[4 * p.offset : 4 * (p.offset + p.length)] == token_files.unsqueezed([own.ids]).tobytes()


def test_packing_nothing(spark, documents):
    assert packing.pack(packing.pieces_of(documents([]), public_tokenizers.path(FILES[1]), 0, 2048)).count() == 0


def test_few_pieces_in_a_group(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_IN_GROUP", 50)
    pieces = spark.range(400).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 200 + 1).alias("length"), F.lit(5).cast("long").alias("ids_crc32"))
    got = packing.pack(pieces).collect()
    assert len(got) == 400
    packed_well([(r.length, r.sequence_id, r.offset) for r in got], packing.Capacity())
