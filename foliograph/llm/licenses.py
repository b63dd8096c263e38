"""Operator 10: licence scans by a generalised suffix automaton.

The word sequences of all templates form one suffix automaton. A document streams through it once; after each word the
automaton holds the longest run of words ending there that stands in some template (the matching statistics). Runs that
cannot grow and are long enough are matches; matches that follow one another both in the document and in a template, with
small gaps, chain to a span, and a span that covers enough of its template gives the template's label. A template that has
one of its licence's marks, the words that tell it from others, needs a mark in the span too; a short one without a mark must
be covered nearly whole. Short base phrases are looked for at the same time and give their labels wherever their words stand.

Defined results: a null or empty text has no words, no labels and score 0; texts of any length are streamed whole; of equally
good spans all are kept; repeated rows give a row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import worker_state

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of well-known licences, as they are published.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so"),
    ("mit", "Released under the MIT license."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced"),
)

# Words that tell a licence from others with like notices, and words that make another licence if they follow.
MARKS = {
    "mit": (("mit license", "mit licence"), ()),
    "apache": (("apache license", "apache licence"), ()),
    "gpl": (("gnu general public license", "gnu general public licence"), ()),
    "lgpl": (("gnu lesser general public license", "gnu lesser general public licence"), ()),
    "mpl": (("mozilla public license", "mozilla public licence"), ()),
    "unlicense": (("free and unencumbered",), ()),
    "cc-by": (("creative commons attribution",), ("sharealike", "share", "sa", "noncommercial", "non", "nc", "noderivs", "noderivatives", "no", "nd")),
    "cc-by-nc": (("cc by nc",), ("sa", "nd")),
    "proprietary": (("no part of this",), ()),
}
SHORT, SHORT_LEAST = 15, 0.9  # templates under so many words without a mark, and the share of them that must be covered

FOUND = ("doc_id long, n_words long, base array<struct<label:string,start:long>>, "
         "spans array<struct<label:string,first:long,last:long,coverage:double>>")


def word_table() -> bytes:
    """Keeps 0-9, a-z and bytes from 128, lower-cases A-Z; every other byte separates."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


WORD_TABLE = word_table()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_TABLE).split()


class SuffixAutomaton:
    """A generalised suffix automaton of integer sequences; ``ends[state]`` lists (sequence, position) of its runs' last items."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, item in enumerate(sequence):
                last = self._extend(last, item)
                state = last
                while state > 0:  # few and short sequences: places are noted on all suffixes at once
                    self.ends[state].append((number, at))
                    state = self.link[state]

    def _state(self, length: int, following: dict, link: int, ends: list) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(link)
        self.ends.append(ends)
        return len(self.length) - 1

    def _split(self, p: int, q: int, item: int) -> int:
        """The state of the shorter runs of q that p leads to; q keeps the longer ones."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], list(self.ends[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(item) == q:
            self.next[p][item] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, item: int) -> int:
        if item in self.next[last]:
            q = self.next[last][item]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, item)
        new, p = self._state(self.length[last] + 1, {}, 0, []), last
        while p >= 0 and item not in self.next[p]:
            self.next[p][item] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][item]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, item)
        return new


class Scanner:
    """Finds base phrases and template spans in word lists."""

    def __init__(self, templates=TEMPLATES, base=BASE, shortest: int = 3, gap: int = 8, least: float = 0.6):
        self.labels = [label for label, _ in templates]
        texts = [words_of(t) for _, t in templates] + [words_of(t) for t, _ in base]
        self.number: dict[bytes, int] = {}
        coded = [[self.number.setdefault(w, len(self.number)) for w in t] for t in texts]
        self.templates = coded[: len(templates)]
        self.automaton = SuffixAutomaton(coded)
        self.phrases: dict[int, list[tuple[list[int], str]]] = {}
        for codes, (_, label) in zip(coded[len(templates):], base, strict=True):
            self.phrases.setdefault(codes[-1], []).append((codes, label))
        self.shortest, self.gap, self.least = shortest, gap, least
        self.marks = []  # of each template, if it has one: phrases and the words that must not follow
        for label, text in templates:
            phrases, others = MARKS.get(label, ((), ()))
            mark = [words_of(p) for p in phrases], set(map(str.encode, others))
            words = words_of(text)
            self.marks.append(mark if self.marked(words, 0, len(words) - 1, mark) else None)

    @staticmethod
    def marked(words: list[bytes], first: int, last: int, mark: tuple[list[list[bytes]], set[bytes]]) -> bool:
        """Whether a phrase of the mark begins between two words, without a word after it that makes another licence."""
        phrases, others = mark
        return any(words[i : i + len(p)] == p and not others.intersection(words[i + len(p) : i + len(p) + 1])
                   for i in range(first, last + 1) for p in phrases)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """Base places (label, first word), and spans (label, first word, last word, covered share of the template)."""
        codes = list(map(self.number.get, words))
        following, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        phrases, shortest = self.phrases, self.shortest
        base, matches, state, run = [], [], 0, 0
        for i, code in enumerate(codes):
            if code is None:
                if run >= shortest:
                    matches.append((i - 1, run, state))
                state = run = 0
                continue
            if code not in following[state]:
                if run >= shortest:
                    matches.append((i - 1, run, state))
                while state and code not in following[state]:
                    state = link[state]
                    run = length[state]
            if code in following[state]:
                state = following[state][code]
                run += 1
            if code in phrases:
                base += [(label, i + 1 - len(p)) for p, label in phrases[code] if run >= len(p) and codes[i + 1 - len(p) : i + 1] == p]
        if run >= shortest:
            matches.append((len(codes) - 1, run, state))
        return base, self.chain(matches, words) if matches else []

    def enough(self, t: int, first: int, last: int, covered: int, words: list[bytes]) -> bool:
        """Whether a span of so many covered words is a notice of the template."""
        n, mark = len(self.templates[t]), self.marks[t]
        if mark is None and n < SHORT:
            return covered >= max(self.least, SHORT_LEAST) * n
        return covered >= self.least * n and (mark is None or self.marked(words, first, last, mark))

    def chain(self, matches: list[tuple[int, int, int]], words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Chains matches per template in the order of the document; those that break the order or the gap start anew."""
        open_: dict[int, list[int]] = {}  # template: first and last word, last template place, words covered
        spans = []

        def close(t: int) -> None:
            first, last, _, covered = open_.pop(t)
            if self.enough(t, first, last, covered, words):
                spans.append((self.labels[t], first, last, covered / len(self.templates[t])))

        for end, run, state in matches:
            for t, place in sorted(self.automaton.ends[state]):
                if t >= len(self.templates):
                    continue
                here = open_.get(t)
                if here is not None:
                    new = min(run, end - here[1], place - here[2])
                    if new > 0 and end - new - here[1] <= self.gap and place - new - here[2] <= self.gap:
                        here[1], here[2], here[3] = end, place, here[3] + new
                        continue
                    if end - run - here[1] < 0 and run <= here[3]:
                        continue  # another place of the same words, no better than the open span
                    close(t)
                open_[t] = [end + 1 - run, end, place, run]
        for t in list(open_):
            close(t)
        return sorted(spans)


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(doc_id, n_words, base, spans): the places of base phrases, and the template spans with their coverage."""
    key = ("licenses", templates, base, tuple(sorted(limits.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_state(key, lambda: Scanner(templates, base, **limits))
        place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))
        for b in batches:
            counts, bases, spans = [], [], []
            for text in b.column(1):
                words = words_of(text.as_py())
                found, covered = scanner.scan(words)
                counts.append(len(words))
                bases.append([{"label": x, "start": s} for x, s in found])
                spans.append([{"label": x, "first": f, "last": e, "coverage": c} for x, f, e, c in covered])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(bases, place), pa.array(spans, span)],
                                             names=["doc_id", "n_words", "base", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FOUND)


def summary(found: DataFrame) -> DataFrame:
    """One row per scanned document: base places and labels, all labels, and how sure they are (a base phrase: 1)."""
    starts = F.transform("base", lambda x: x["start"])
    named = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.transform(x, lambda y: y["label"]) for x in c)))), ",")
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["coverage"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), named("base").alias("base_labels"), named("base", "spans").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"))
