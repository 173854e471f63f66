"""Licence scans with a generalised suffix automaton of licence words.

All phrases and templates are in one automaton, built on the driver from fixed texts (some hundred
states), and shipped with the tasks. The words of a file are streamed through it: the matching
statistics say, at each word, how many words up to there occur together in some template. A phrase
is found wherever the state at a word has the phrase among its suffixes. Matches of at least
``LONG`` words that can't be prolonged are chained, in order and with small gaps, into
covered spans of a template; a template is found where a chain covers ``COVERED`` of it.

Defined cases: null text counts as empty; a text without words has none of anything and score 0;
repeated rows are scanned each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The phrases and their labels, and opening or notice texts of public licences.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
            "with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Words of the shortest match that a chain uses, share of a template that it has to cover, words between its matches at most.
LONG, COVERED, GAP = 4, 0.6, 24
# Words are runs of 0-9, a-z and everything beyond ASCII; A-Z counts as a-z.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton of word-id sequences; sequence numbers and end places of each state."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length = [{}], [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence):
                last = self._extend(last, word)
                self.places[last].add((number, end))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(dict(edges))
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state for the shorter strings of ``target`` that come from ``at`` by ``word``."""
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(self.length[at] + 1, self.next[target], self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word, self.next[at][word])
        return state


class Scanner:
    """Phrases, templates and their automaton."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES):
        self.vocabulary: dict[bytes, int] = {}
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(t)] for t in [*phrases, *(t for _, t in templates)]]
        self.sequences, self.labels, self.n_phrases = ids, [*phrases.values(), *(label for label, _ in templates)], len(phrases)
        self.automaton = a = Automaton(ids)
        ends = {}
        for p in range(self.n_phrases):
            state = 0
            for w in ids[p]:
                state = a.next[state][w]
            ends.setdefault(state, []).append((p, len(ids[p])))
        self.phrases: list[list[tuple[int, int]]] = [[]]  # by state: the phrases among its suffixes
        self.phrases *= len(a.next)
        for state in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.phrases[state] = ends.get(state, []) + self.phrases[a.link[state]]
        self.shortest = min(map(len, ids))

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words))
        known = np.flatnonzero(ids >= 0)
        base: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int, int]] = []
        if len(known):
            cuts = np.flatnonzero(np.diff(known) > 1) + 1
            firsts, lasts = known[np.r_[0, cuts]], known[np.r_[cuts - 1, len(known) - 1]]
            for i in np.flatnonzero(lasts - firsts + 1 >= self.shortest).tolist():
                self._run(ids[firsts[i] : lasts[i] + 1].tolist(), int(firsts[i]), base, matches)
        best = self._chains(matches)
        base_labels = {self.labels[p] for p, _ in base}
        found = {self.labels[t] for t, share in best.items() if share >= COVERED}
        starts = [start for _, start in base]
        score = 1.0 if base else max(best.values(), default=0.0)
        return (
            len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | found)), min(1.0, score),
        )

    def _run(self, ids: list[int], offset: int, base: list, matches: list) -> None:
        """Matching statistics of one run of licence words; phrases and matches that can't be prolonged."""
        a, state, length = self.automaton, 0, 0
        for i, word in enumerate([*ids, -1]):
            at, kept = state, length
            while at > 0 and word not in a.next[at]:
                at = a.link[at]
                kept = a.length[at]
            if word in a.next[at]:
                new, new_length = a.next[at][word], kept + 1
            else:
                new, new_length = 0, 0
            if length >= LONG and new_length != length + 1:
                for number, end in a.places[state]:
                    matches.append((number, offset + i - length, end - length + 1, length))
            state, length = new, new_length
            for phrase, size in self.phrases[state]:
                if length >= size:
                    base.append((phrase, offset + i - size + 1))

    def _chains(self, matches: list[tuple[int, int, int, int]]) -> dict[int, float]:
        """The largest share of each sequence that one chain covers."""
        best: dict[int, float] = {}
        recent: dict[int, list[tuple[int, int, int]]] = {}  # by sequence: text end, sequence end, words covered
        for number, at, place, length in sorted(matches, key=lambda m: m[1] + m[3]):
            held = [c for c in recent.get(number, []) if at - c[0] <= GAP]
            covered = length
            for text_end, end, words in held:
                overlap = max(0, text_end - at, end - place)
                if text_end <= at + length and end <= place + length and overlap < length:
                    covered = max(covered, words + length - overlap)
            held.append((at + length, place + length, covered))
            recent[number] = held
            best[number] = max(best.get(number, 0.0), covered / len(self.sequences[number]))
        return best


RESULT = "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, labels: string, score: double>"


def scanned(docs: DataFrame, text_col: str = "text") -> Column:
    """The scan of each row's text, as a struct."""
    scanner = Scanner()
    names = [x.split(":")[0].strip() for x in RESULT[7:-1].split(",")]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run(F.col(text_col))
