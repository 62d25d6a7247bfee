from __future__ import annotations

import random
import re

import pytest

from paylens.llm.license_scan import BASE, TEMPLATES, Automaton, license_scan, scan_text, words_of
from paylens.llm.license_templates import IDENTIFIERS

KNOWN = [words_of(t) for _, t in TEMPLATES] + [words_of(t) for t in BASE]


def occurs(seq):
    return any(t[i : i + len(seq)] == seq for t in KNOWN for i in range(len(t)))


def test_matching_statistics():
    automaton, rng = Automaton(TEMPLATES, BASE), random.Random(2)
    vocabulary = [*automaton.vocabulary, "xx", "yy"]
    for _ in range(60):
        words = []
        while len(words) < 50:
            template = rng.choice(KNOWN)
            start = rng.randrange(len(template))
            part = template[start : start + rng.randrange(1, 12)]
            words += part if rng.random() < 0.5 else [rng.choice(vocabulary)]
        found, matches = automaton.scan(words, 1)
        phrases = [
            (i, label)
            for text, label in BASE.items()
            for i in range(len(words))
            if words[i : i + len(words_of(text))] == words_of(text)
        ]
        assert sorted(found) == sorted(phrases)
        longest = []
        for end in range(1, len(words) + 1):
            size = 0
            while size < end and occurs(words[end - size - 1 : end]):
                size += 1
            longest.append(size)
        maximal = [
            (i + 1, n)
            for i, n in enumerate(longest)
            if n and (i + 1 == len(longest) or longest[i + 1] != n + 1)
        ]
        assert [(end, size) for end, size, _ in matches] == maximal


def test_spans_bridge_changed_words():
    text = " ".join(words_of(TEMPLATES[0][1])).replace("without limitation", "without any limits")
    *_, labels, score, spans = scan_text(Automaton(TEMPLATES, BASE), f"x {text} y")
    assert labels == "mit" and 0.9 < score < 1
    assert [(s["start"], s["label"]) for s in spans] == [(1, "mit")]


def test_rows(table, with_clashes):
    rows = [
        (1, "The MIT License, the mit-license: Apache  License"),
        (2, None),
        (3, ""),
        (None, "CC BY-NC 4.0; Licensed under CC BY-NC 4.0."),
        (4, "mité license MIT LICENSEé"),
        (4, "nothing " * 50_000 + "GNU General Public License"),
    ]
    got = sorted(license_scan(with_clashes(table(rows))).collect(), key=lambda r: r["n_words"])
    by = {(r["doc_id"], r["n_base"]): r for r in got}
    assert by[1, 3]["base_labels"] == "apache,mit" and by[1, 3]["first_word"] == 1
    assert by[1, 3]["last_word"] == 6
    assert by[2, 0]["n_words"] == by[3, 0]["n_words"] == 0 and by[2, 0]["first_word"] is None
    assert by[None, 2]["labels"] == "cc-by,cc-by-nc"
    assert by[4, 0]["labels"] == "" and by[4, 1]["first_word"] == 50_000
    assert all(0 <= r["score"] <= 1 for r in got)
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    assert by[4, 0]["n_words"] == len(words.findall("mité license mit licenseé"))
    assert license_scan(table([])).count() == 0


def test_spans_over_insertions_with_common_phrases():
    automaton, rng = Automaton(TEMPLATES, BASE), random.Random(5)
    whole = words_of(TEMPLATES[0][1])
    at = whole.index("without")
    for text in ("as part of the software bundle", "of the software " + "xx " * 40):
        words = ["y"] + whole[:at] + words_of(text) + whole[at:] + ["y"]
        *_, labels, score, spans = scan_text(automaton, " ".join(words))
        assert labels == "mit" and score == 1.0
        assert [(s["start"], s["end"]) for s in spans] == [(1, len(words) - 1)]
    phrases = ["of the software", "the license", "this file", "to use copy", "and or", "xx", "zz " * 30]
    for label, text in TEMPLATES:
        whole = words_of(text)
        if len(whole) < 18:
            continue
        for _ in range(20):
            at = rng.randrange(6, len(whole) - 5)  # long pieces on both sides
            held = " ".join(rng.choice(phrases) for _ in range(rng.randrange(1, 6)))
            words = whole[:at] + held.split() + whole[at:]
            _, _, _, _, _, labels, score, _ = scan_text(automaton, " ".join(words))
            assert label in labels.split(",") and score >= 0.8


def test_every_copy_gives_a_span():
    whole = words_of(TEMPLATES[0][1])
    part = whole[:20] + ["xx"] + whole[21:]
    words = whole + whole + ["y"] * 30 + part + ["y"] * 5 + whole[:10]
    spans = scan_text(Automaton(TEMPLATES, BASE), " ".join(words))[-1]
    n = len(whole)
    assert [(s["start"], s["end"]) for s in spans] == [(0, n), (n, 2 * n), (2 * n + 30, 3 * n + 30)]


def test_scattered_short_matches_give_no_label():
    whole = words_of(TEMPLATES[10][1])
    pairs = [" ".join(whole[i : i + 2]) for i in range(0, len(whole), 2)]
    assert scan_text(Automaton(TEMPLATES, BASE), (" xx" * 20 + " ").join(pairs))[5] == ""


ALL = Automaton(TEMPLATES, BASE, IDENTIFIERS)


def labels_of(text):
    return set(scan_text(ALL, text)[5].split(",")) - {""}


@pytest.mark.parametrize("label, text", TEMPLATES)
def test_each_notice_in_other_clothes(label, text):
    assert label in labels_of(text)
    words = text.split()
    lines = "\n# ".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7))
    assert label in labels_of(f"# Copyright (c) 1999 Ada Example\n# {lines.upper()}\n x = 1")
    if len(words) >= 18:  # one word replaced by a name of three
        words[len(words) // 2] = "Ada Example Ltd"
        assert label in labels_of(" ".join(words))


@pytest.mark.parametrize("name, label", IDENTIFIERS.items())
def test_identifiers(name, label):
    for text in (f"// SPDX-License-Identifier: {name}\nint x;", f"/* spdx-license-identifier: {name} */"):
        base = set(scan_text(ALL, text)[4].split(",")) - {""}  # "cc by" is a base phrase
        assert labels_of(text) == {label} | base


def test_alike_licences_are_told_apart():
    affero = next(text for label, text in TEMPLATES if label == "agpl-3.0")
    assert labels_of(affero) == {"agpl-3.0"}
    boost = next(text for label, text in TEMPLATES if label == "boost")
    assert labels_of(boost) == {"boost"}
    share = next(text for label, text in TEMPLATES if label == "cc-by-sa")
    assert labels_of(share) == {"cc-by-sa"}
    assert labels_of("SPDX-License-Identifier: Apache-2.0 OR MIT") == {"apache-2.0"}
    assert labels_of("a list of conditions and of rights in the public domain, with no warranty") == set()
