"""Token ids of whole texts, from public tokenizer files.

A byte-pair tokenizer first cuts a text into words and never looks across a
cut.  Texts repeat their words, so each worker keeps the ids of the words it
has met in two calls and asks the ``tokenizers`` library only for others; most words of a
corpus come once, and keeping those is what would fill its memory. The ids are those of encoding the whole text.  Where a text is spaced so that
cutting at blanks could differ from the tokenizer's own cuts, where it holds
the string of an added token, or where its letters are not composed as the
tokenizer composes them, the library encodes the whole text.
"""

from __future__ import annotations

import re
import string
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

#: Words kept per worker process (twice as many at most), and the longest kept: they bound its memory.
KEPT_WORDS = 300_000
LONGEST_KEPT = 40
#: Marks of words met once (one byte each, by the word's hash): a word is kept when it is met again.
MARKS = 1 << 22
#: Texts whose new words are encoded in one call.
TEXTS_AT_ONCE = 64


class _BytesAsText(dict):
    """Each character as the signs by which the library's vocabularies write its UTF-8 bytes."""

    def __missing__(self, code: int) -> str:
        from tokenizers.pre_tokenizers import ByteLevel

        self[code] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        return self[code]


class Encoder:
    """Ids of texts under one tokenizer file, those of ``Tokenizer.encode(text, add_special_tokens=False)``.

    With ``special_as_text`` the strings of special tokens are read as ordinary
    text, as the library does with ``encode_special_tokens``.

    Two kinds of files are told apart by a trial: those that keep white space,
    where a word carries the blank before it, and those that drop it (and may
    lower the case).
    """

    #: A blank whose neighbours both are white space: such runs are cut by rules of their own.
    _SPACED = re.compile(r" (?<=\s )(?=\s|\Z)")
    #: In an ASCII text such a blank is one of these pairs, or the last sign.
    _PAIRS = tuple(" " + space for space in " \t\n\r\x0b\x0c")
    #: Python's split() takes the first four for white space, the tokenizers don't; the last marks words here.
    _MARKS = "\x1c\x1d\x1e\x1f\x00"
    #: Runs that the tokenizers never join: letters, digits, other signs; a line end stands alone.
    _RUNS = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+|\n")
    #: Signs that make one run; the apostrophe has rules of its own.
    _SIGNS = string.punctuation.replace("'", "")

    def __init__(self, path: str, special_as_text: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        self.added = tuple(t.content for t in added if not t.normalized)
        # Added tokens that are looked for in the normalized text are found in either case here.
        normalized = [re.escape(t.content) for t in added if t.normalized]
        self.added_normalized = re.compile("|".join(normalized), re.IGNORECASE) if normalized else None
        self.keeps_space = len(self.whole("a b")) != len(self.whole("a  b"))
        self.lowers = self.whole("ÀB") == self.whole("àb")
        self.bytes_as_text = _BytesAsText()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = bytearray(MARKS)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, text: str) -> bytes:
        return np.array(self.whole(text), dtype="<u4").tobytes()

    def _cut(self, text: str) -> list[str] | None:
        """Words whose ids in a row are the text's; None if only the whole text gives them."""
        if any(mark in text for mark in self._MARKS):
            return None
        if any(string in text for string in self.added) or self.added_normalized and self.added_normalized.search(text):
            return None
        if not self.keeps_space:
            lower = text.lower() if self.lowers and "Σ" not in text else text  # Σ's lower case depends on its place, in Python alone
            if not text.isascii() and not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower)):
                return None  # the tokenizer composes first, then lower-cases: h and a mark may compose where H and it don't
            return lower.split()
        doubtful = not text.isascii() or any(pair in text for pair in self._PAIRS) or text[-1] == " "
        if doubtful and self._SPACED.search(text):
            return None
        words = text.split(" ")
        words[0] = "\x00" + words[0]  # a leading mark: no blank before this word
        return words

    def _learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of new words: of plain runs from the library's model, else of the whole word."""
        found: dict[str, bytes] = {}
        model, table, known = self.tokenizer.model.tokenize, self.bytes_as_text, self.young.get
        blank, keeps_space, signs_alone = table[32] if self.keeps_space else "", self.keeps_space, self._SIGNS
        for word in words:
            ascii_ = word.isascii()
            plain = keeps_space or ascii_ and word.islower() or self._plain(word)
            if plain and word.isalpha():
                signs = word if ascii_ else word.translate(table)
                found[word] = array("I", [x.id for x in model(blank + signs)]).tobytes()
                continue
            bare = word.removeprefix("\x00")
            lead = blank if bare is word else ""
            if plain and not keeps_space and (letters := word.strip(signs_alone)).isalpha():  # most others: letters between signs
                before, after = word.split(letters)
                runs = (before, letters, after)
            else:
                runs = self._runs(bare) if plain else ()
            out = [] if runs else [self._packed((" " if lead else "") + bare)]
            for run in runs:
                if not run:
                    continue
                key = run if lead or not keeps_space else "\x00" + run
                if (ids := found.get(key) or known(key)) is None:
                    signs = run if run.isascii() and run.isprintable() else run.translate(table)
                    ids = found[key] = array("I", [x.id for x in model(lead + signs)]).tobytes()
                out.append(ids)
                lead = ""
            found[word] = b"".join(out)
        return found

    def _plain(self, word: str) -> bool:
        """The tokenizer's normalizing leaves the word as it is."""
        return self.lowers and word == word.lower() and (word.isascii() or unicodedata.is_normalized("NFC", word))

    def _runs(self, bare: str) -> list[str]:
        """The runs of a word; none where contractions, odd numerals or white space make rules of their own."""
        letters = bare.strip(self._SIGNS)
        if letters.isalpha():  # most words
            at = bare.index(letters)
            return [run for run in (bare[:at], letters, bare[at + len(letters) :]) if run]
        runs = self._RUNS.findall(bare)
        if "'" in bare or "".join(runs) != bare:
            return []
        if "\n" in bare and (bare[0] == "\n" or bare[-1] == "\n" or "\n\n" in bare):
            return []
        for run in runs:
            if not (run.isalpha() or run.isdecimal() or not run[0].isalnum()):
                return []
        if not self.keeps_space:  # these take digits one by one
            return [x for run in runs for x in (run if run.isdecimal() else [run])]
        return runs

    def _keep(self, new: dict[str, bytes]) -> None:
        """Of the words just met, keep those met before; a mark shared by two words only keeps one more."""
        met, last, old, young = self.met, MARKS - 1, self.old, self.young
        for word, ids in new.items():
            mark = hash(word) & last
            if not (met[mark] or word in old):
                met[mark] = 1
            elif len(word) <= LONGEST_KEPT:
                young[word] = ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        if len(self.young) > KEPT_WORDS:
            self.old, self.young, self.met = self.young, {}, bytearray(MARKS)
        cut = [self._cut(text) if text else [] for text in texts]
        ids = [list(map(self.young.get, words)) if words else words for words in cut]
        holes = [_holes(found) if found else [] for found in ids]
        missing = {words[i] for words, own in zip(cut, holes, strict=True) for i in own}
        if missing:
            new = {w: x for w in missing if (x := self.old.get(w)) is not None}
            new |= self._learn(missing.difference(new))
            self._keep(new)
            for words, found, own in zip(cut, ids, holes, strict=True):
                for i in own:
                    found[i] = new[words[i]]
        return [self._packed(text) if found is None else b"".join(found) for text, found in zip(texts, ids, strict=True)]


def _holes(found: list[bytes | None]) -> list[int]:
    at, i = [], -1
    try:
        while True:
            i = found.index(None, i + 1)
            at.append(i)
    except ValueError:
        return at


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process: read once, its words kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path, special_as_text=False)
    return _ENCODERS[path]


def encode_texts(path: str, texts: Iterable[str | None], end_id: int) -> Iterator[bytes]:
    """Ids of each text with ``end_id`` appended."""
    end = np.array([end_id], dtype="<u4").tobytes()
    own, some = encoder(path), []
    for text in texts:
        some.append(text)
        if len(some) == TEXTS_AT_ONCE:
            yield from (ids + end for ids in own.encode(some))
            some = []
    yield from (ids + end for ids in own.encode(some))
