"""Licence scan by matching statistics against a suffix automaton of licence templates.

All templates, as word sequences, go into one generalised suffix automaton. A text is
streamed through it word by word: at each word the automaton gives the longest run of words
ending there that occurs in some template. Runs that cannot be extended and are long enough
are matches. Per template, dynamic programming over the pieces of all matches finds the chain, in
the order of text and template, that covers most of its words; a template that is covered far
enough gives its label and a span. Pieces of a chain are at most some words of text apart, but for
two long ones, which may be any distance apart. An identifier's template (``IDENTIFIERS`` behind
``TAG``) counts when all of its words are covered. Licences share much of their wording, so a span that
bridges words of the text gives way to one of another label around it that leaves fewer uncovered.
Labels of the short
base phrases come from the same pass: a phrase stands where the run's state has it as suffix.

The automaton is built from the given templates alone, so its size does not depend on the data.

Defined cases: a null or empty text has no words, no labels and score 0; any text length
works, as only the current run and the matches are kept.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from paylens.llm.common import id_and_text, lower, read_table
from paylens.llm.license_templates import IDENTIFIERS, NOTICES, TAG

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices that projects put into their files, by label.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without "
     "restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this "
     "file except in compliance with the license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
     "terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international "
     "license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
     "or without fee is hereby granted provided that the above copyright notice"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 "
     "0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    *NOTICES,
]
LEAST_MATCH = 2  # words of a match that counts
MAX_GAP = 12  # words of text between matches of one span
LONG_MATCH = 5  # words of pieces that belong together at any distance
COVERED = 0.8  # part of a template that gives its label

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(lower(text))


class Automaton:
    """Generalised suffix automaton over word ids, with the places of every state."""

    def __init__(
        self,
        templates: list[tuple[str, str]],
        phrases: dict[str, str],
        identifiers: dict[str, str] | None = None,
    ):
        named = [(label, words_of(text)) for label, text in templates]
        named += [(label, words_of(text)) for text, label in phrases.items()]
        self.first_identifier = len(named)
        named += [(label, words_of(f"{TAG} {text}")) for text, label in (identifiers or {}).items()]
        self.labels = [label for label, _ in named]
        self.words = [words for _, words in named]
        self.pieces: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        self.lengths = [len(words) for _, words in named]
        self.vocabulary: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for k, (_, words) in enumerate(named):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                while len(ends) < len(self.link):
                    ends.append([])
                ends[last].append((k, i))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            ends[self.link[state]] += ends[state]
        self.ends = [sorted(set(e)) for e in ends]
        # (length, label) of the base phrases that each state's words end with, at full length
        at: dict[int, tuple[int, str]] = {}
        for text, label in phrases.items():
            state = 0
            for word in words_of(text):
                state = self.next[state][self.vocabulary[word]]
            at[state] = (len(words_of(text)), label)
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for state in sorted(range(1, len(self.link)), key=lambda s: self.length[s]):
            own = [at[state]] if state in at else []
            self.phrases[state] = own + self.phrases[self.link[state]]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of the current template's words so far and this word."""
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def _split(self, state: int, word: int) -> int:
        """The state reached by word whose longest words are one longer than state's."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def scan(self, words: list[str], least: int) -> tuple[list, list]:
        """(start, label) of base phrases; (end, length, state) of matches, ends exclusive."""
        found, matches = [], []
        follow, link, length, phrases = self.next, self.link, self.length, self.phrases
        ids = list(map(self.vocabulary.get, words))
        state = run = 0
        for i, word in enumerate(ids):
            if word is None:
                if run:
                    if run >= least:
                        matches.append((i, run, state))
                    state = run = 0
                continue
            if word not in follow[state]:
                if run >= least:
                    matches.append((i, run, state))
                while state and word not in follow[state]:
                    state = link[state]
                run = length[state]
            state = follow[state].get(word, 0)
            run = run + 1 if state else 0
            for size, label in phrases[state]:
                if size <= run:
                    found.append((i + 1 - size, label))
        if run >= least:
            matches.append((len(ids), run, state))
        return found, matches

    def fragments(self, run: int, state: int) -> list[tuple[int, int, int, int]]:
        """Where the words of a match stand in any template: (template, offset, begin, size).

        Every longest common piece of two words or more, also of templates that hold a part of the
        match only. Kept by state and length, of which there are as many as pieces of templates.
        """
        known = self.pieces.get((run, state))
        if known is not None:
            return known
        k, at = self.ends[state][0]
        words = self.words[k][at + 1 - run : at + 1]
        known = self.pieces[run, state] = []
        for k, template in enumerate(self.words):
            for shift in range(1 - run, len(template)):  # template place less match place
                size = 0
                for i in range(max(0, -shift), min(run, len(template) - shift) + 1):
                    if i < run and i + shift < len(template) and words[i] == template[i + shift]:
                        size += 1
                        continue
                    if size >= min(run, 2):
                        known.append((k, i - size, i - size + shift, size))
                    size = 0
        return known

    def spans(self, matches: list, max_gap: int) -> list[tuple[int, int, int, float]]:
        """Chains of matches, as (template, start, end, covered part of the template).

        Per template the ordered cover of most words, then the best of what it leaves, as long as
        chains cover ``COVERED``; first over gaps of ``max_gap`` words of text at most, then also
        over any gap between two long pieces.
        """
        by: dict[int, set[tuple[int, int, int]]] = {}
        for end, run, state in matches:
            for template, offset, begin, size in self.fragments(run, state):
                by.setdefault(template, set()).add((end - run + offset + size, begin, size))
        chains = []
        for template, found in by.items():
            left, length = sorted(found), self.lengths[template]
            for far in (False, True):
                while left and (not far or any(f[2] >= LONG_MATCH for f in left)):
                    best = _chains(left, max_gap, far)
                    good = [c for c in best if c[2] >= COVERED * length]
                    taken: list[tuple[int, int]] = []
                    for start, end, size in good or best[:1]:
                        at = bisect.bisect_left(taken, (end, 0))
                        if at and taken[at - 1][1] > start:
                            continue  # stands in or across one that covers more
                        bisect.insort(taken, (start, end))
                        chains.append((template, start, end, size / length))
                    if not good:
                        break
                    left = _outside(left, taken)
        return chains


def _chains(fragments: list, max_gap: int, far: bool) -> list[tuple[int, int, int]]:
    """(start, end, words covered) of the best chain up to each fragment, best first.

    Of equal covers the one with the shorter text is taken. Pieces that overlap the chain before
    them in text or template count from where it ends.
    """
    done: list[tuple[int, int, int, int, int]] = []  # end, template end, covered, start, size
    longs: dict[int, tuple[int, int, int, int, int]] = {}  # best by template end
    first = 0
    reach = max((size for *_, size in fragments), default=0)
    for end, begin, size in fragments:
        start = end - size
        while first < len(done) and done[first][0] < end - reach - max_gap:
            first += 1
        best = (size, start)
        before = done[first:]
        if far and size >= LONG_MATCH:
            before += longs.values()
        for x, y, covered, chain_start, last in before:
            cut = max(0, x - start, y - begin)
            if cut >= size or (covered + size - cut, chain_start) <= best:
                continue
            if start + cut - x <= max_gap or (
                far and last >= LONG_MATCH and size - cut >= LONG_MATCH
            ):
                best = (covered + size - cut, chain_start)
        own = (end, begin + size, best[0], best[1], size)
        done.append(own)
        if size >= LONG_MATCH:
            old = longs.get(own[1])
            if old is None or (old[2], old[3]) <= (own[2], own[3]):
                longs[own[1]] = own
    out = [(start, end, covered) for end, _, covered, start, _ in done]
    return sorted(out, key=lambda c: (-c[2], c[1] - c[0], c[0]))


def _undisputed(labels: list[str], lengths: list[int], chains: list) -> list:
    """Chains but those whose text one of another label, around them, covers with fewer words left."""
    out: list[tuple[int, int, int, float]] = []
    before: list[tuple[int, int, str]] = []  # end, words left, label; few, as one template's do not overlap
    rows = [(start, -end, end - start - round(part * lengths[k]), k, part) for k, start, end, part in chains]
    for start, end, missed, k, part in sorted(rows):  # those around one come before it
        before = [b for b in before if b[0] > start]
        if not any(b[0] >= -end and b[1] < missed and b[2] != labels[k] for b in before):
            out.append((k, start, -end, part))
        before.append((-end, missed, labels[k]))
    return out


def _outside(fragments: list, taken: list[tuple[int, int]]) -> list:
    """Fragments that lie outside all of the taken stretches of text."""
    out = []
    for end, begin, size in fragments:
        at = bisect.bisect_left(taken, (end, 0))
        if not at or taken[at - 1][1] <= end - size:
            out.append((end, begin, size))
    return out


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:long,end:long,covered:double>>"
)
_SPANS = pa.list_(
    pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]
    )
)


def scan_text(automaton: Automaton, text: str, least=LEAST_MATCH, gap=MAX_GAP, covered=COVERED):
    """The result columns of one text, without doc_id."""
    words = words_of(text)
    found, matches = automaton.scan(words, least)
    chains = automaton.spans(matches, gap)
    enough = [c for c in chains if c[3] >= (covered if c[0] < automaton.first_identifier else 1)]
    spans = [
        {"label": automaton.labels[k], "start": start, "end": end, "covered": part}
        for k, start, end, part in _undisputed(automaton.labels, automaton.lengths, enough)
    ]
    spans.sort(key=lambda s: (s["start"], s["end"], s["label"]))
    starts = [start for start, _ in found]
    base = {label for _, label in found}
    score = max((part for *_, part in chains), default=0.0)
    return (
        len(words),
        len(found),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {s["label"] for s in spans})),
        1.0 if found else min(1.0, score),
        spans,
    )


def license_scan(
    docs: DataFrame, templates=TEMPLATES, phrases=BASE, identifiers=IDENTIFIERS, **limits
) -> DataFrame:
    """One row per document: base phrases, labels, score and covered template spans."""
    automaton = Automaton(templates, phrases, identifiers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(automaton, t, **limits) for t in batch["text"].to_pylist()]
            cols = list(zip(*rows)) or [[] for _ in range(8)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                 "labels", "score", "spans"],
            )

    return id_and_text(docs).mapInArrow(run, _SCHEMA)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))
