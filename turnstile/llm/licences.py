"""Licence scan by a generalised suffix automaton of licence words.

The automaton holds every run of words of every template.  A text streams
through it once and yields matching statistics: at each word the longest run
ending there that some template has.  Runs that cannot be extended and are long
enough are chained per template, in the order of both sides and without long
gaps; the share of the template's words under the best chain is its coverage.  Beside its
share a chain has to hold the words that tell its template from those of other
labels, and its numbers; a short template in part gives way to another label's
that is there as a whole and goes on where it ends.

Base phrases are templates too: the automaton's states tell at each word which
of them end there.  Words are lower-cased (A to Z alone) runs of digits, ASCII
letters and characters beyond ASCII.  Null texts are empty; null and repeated
ids are kept row by row; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from turnstile.llm.common import document_columns, query, table
from turnstile.llm.token_files import slices

#: Fixed values of the contract: base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Well-known wordings by label: names of licences, notices in files, and openings of licence texts.
TEMPLATES = {
    "mit": [
        "released under the MIT License",
        "licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
    ],
    "apache-2.0": [
        "licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "gpl": [
        "licensed under the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "gpl-3.0": ["GNU General Public License, version 3"],
    "gpl-2.0": ["GNU General Public License, version 2"],
    "lgpl": ["GNU Lesser General Public License"],
    "agpl": ["GNU Affero General Public License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "cc-by": ["licensed under CC BY", "Creative Commons Attribution", "licensed under a Creative Commons Attribution License"],
    "cc-by-nc": ["licensed under CC BY-NC", "Creative Commons Attribution-NonCommercial"],
    "cc-by-sa": ["licensed under CC BY-SA", "Creative Commons Attribution-ShareAlike"],
    "cc-by-nd": ["licensed under CC BY-ND", "Creative Commons Attribution-NoDerivatives"],
    "cc-by-nc-sa": ["licensed under CC BY-NC-SA", "Creative Commons Attribution-NonCommercial-ShareAlike"],
    "cc-by-nc-nd": ["licensed under CC BY-NC-ND", "Creative Commons Attribution-NonCommercial-NoDerivatives"],
    "cc0": ["CC0 1.0 Universal"],
}

#: Shortest run that counts, most words between chained runs, and least coverage of a template that gives its label.
SHORTEST, GAP, COVERED = 2, 6, 0.75
#: Words of a short template.
SHORT = 8
_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD or c >= 0x80 else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


class Span(NamedTuple):
    label: str
    template: int
    first: int  # words of the text, both ends included
    last: int
    coverage: float


class Automaton:
    """States of all runs of words of the templates; small, as the templates are."""

    def __init__(self, templates: list[list[bytes]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.templates = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in t] for t in templates]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: For each state, where its runs end: (template, place of the last word).
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, template in enumerate(self.templates):
            last = 0
            for at, word in enumerate(template):
                last = self._extended(last, word)
                self.ends[last].add((k, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state] if self.link[state] else set()

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the shorter runs of ``target`` that end with ``word`` after ``state``."""
        if self.length[target] == self.length[state] + 1:
            return target
        part = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _extended(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier template has this run
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def statistics(self, text: list[bytes]):
        """(place, state, length) at every word where some template has the run that ends there."""
        state = length = 0
        for at, word in enumerate(map(self.vocabulary.get, text)):
            if word is None:
                state = length = 0
                continue
            while word not in self.next[state]:  # the root knows every word of the vocabulary
                state = self.link[state]
                length = self.length[state]
            state, length = self.next[state][word], length + 1
            yield at, state, length


def needed_places(own: list[bytes], others: list[list[bytes]]) -> int:
    """Places (as bits) of a template without which it is not told from those of other labels."""
    places = {i for i, w in enumerate(own) if w.isdigit()}
    for other in others:
        apart = [i for i, w in enumerate(own) if w not in other]
        if len(own) - len(apart) >= COVERED * len(own):  # the other's words would do for this one
            places |= set(apart or range(len(own)))
    return sum(1 << i for i in places)


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, templates: dict[str, list[str]] = TEMPLATES) -> None:
        self.base = [(words(phrase), label) for phrase, label in base.items()]
        named = [(label, words(text)) for label, texts in templates.items() for text in texts]
        self.labels = [label for _, label in self.base] + [label for label, _ in named]
        self.automaton = Automaton([w for w, _ in self.base] + [w for _, w in named])
        every = [w for w, _ in self.base] + [w for _, w in named]
        self.needed = [needed_places(w, [o for o, label in zip(every, self.labels, strict=True) if label != own]) for w, own in zip(every, self.labels, strict=True)]
        a = self.automaton
        #: Of each state, the base phrases that end its runs, with their lengths.
        self.ending = [[(k, len(w)) for k, (w, _) in enumerate(self.base) if (k, len(w) - 1) in ends] for ends in map(self._own_ends, range(len(a.link)))]

    def _own_ends(self, state: int) -> set[tuple[int, int]]:
        """Ends of the runs that the state's runs end with: those of whole phrases among it and its links."""
        found = set()
        while state > 0:
            found |= {(k, at) for k, at in self.automaton.ends[state] if at + 1 == self.automaton.length[state]}
            state = self.automaton.link[state]
        return found

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[Span]]:
        """Number of words, (start, base phrase) of every place of one, and covered template spans."""
        own, places, runs, previous = words(text), [], [], None
        for at, state, length in self.automaton.statistics(own):
            for k, n in self.ending[state]:
                if length >= n:
                    places.append((at - n + 1, k))
            if previous and (previous[0] != at - 1 or length <= previous[2]):
                runs.append(previous)
            previous = at, state, length
        if previous:
            runs.append(previous)
        return len(own), places, self._chained([r for r in runs if r[2] >= SHORTEST])

    def _chained(self, runs: list[tuple[int, int, int]]) -> list[Span]:
        """Chains of runs per template, as long as gaps are short; of overlapping words only new ones count."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for at, state, length in runs:
            for k, end in self.automaton.ends[state]:
                by_template.setdefault(k, []).append((at, end, length))
        out = []
        for k, anchors in by_template.items():
            n = len(self.automaton.templates[k])
            open_: list[list[int]] = []  # chains: first word, last word, last place in the template, words covered, their places as bits
            for at, end, length in anchors:
                best = None
                for chain in open_:
                    if 0 < at - chain[1] <= GAP + length and end > chain[2] and (best is None or chain[3] > best[3]):
                        best = chain
                fresh = [at - length + 1, at, end, length, _bits(end, length)]
                if best:
                    new = min(length, at - best[1], end - best[2])
                    joined = [best[0], at, end, best[3] + new, best[4] | _bits(end, new)]
                    if joined[3] > fresh[3]:
                        fresh = joined
                open_ = [c for c in open_ if at - c[1] <= GAP + n] + [fresh]
                if fresh[3] >= COVERED * n and fresh[4] & self.needed[k] == self.needed[k]:
                    out.append(Span(self.labels[k], k, fresh[0], fresh[1], fresh[3] / n))
        whole = [t for t in out if t.coverage == 1]
        return [s for s in out if not (s.coverage < 1 and len(self.automaton.templates[s.template]) <= SHORT and any(t.label != s.label and t.first <= s.last < t.last for t in whole))]


def _bits(end: int, n: int) -> int:
    return ((1 << n) - 1) << (end - n + 1)


_SCANNER: list[Scanner] = []


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places of base phrases, labels, score and spans of each document."""

    def work(batches):
        if not _SCANNER:
            _SCANNER.append(Scanner())
        own = _SCANNER[0]
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                n, places, spans = own.scan(text)
                base = {own.base[k][1] for _, k in places}
                starts = [s for s, _ in places]
                best: dict[tuple[str, int], Span] = {}
                for s in spans:
                    if (s.label, s.first) not in best or best[s.label, s.first].coverage < s.coverage:
                        best[s.label, s.first] = s
                score = max([float(bool(places)), *(s.coverage for s in spans)])
                rows.append((
                    n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {s.label for s in spans})), score,
                    [{"label": s.label, "first": s.first, "last": s.last, "coverage": s.coverage} for s in best.values()],
                ))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["doc_id", *names])

    return document_columns(docs, "doc_id", "text").mapInArrow(
        work,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label string, first long, last long, coverage double>>",
    )


@query("op5_suffix_automaton")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return scanned(table(spark, folder, "documents")).drop("spans")
