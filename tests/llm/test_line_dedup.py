from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from paylens.llm import line_dedup

LAST = 2**63 - 1


def brute(rows):
    first = {}

    def key(line):
        return line.strip(" \t\n\v\f\r").translate(
            {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
        )

    def at(doc_id):
        return LAST if doc_id is None else doc_id

    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), LAST), at(doc_id))
    out = Counter()
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if at(doc_id) <= first.get(key(x), LAST)]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[doc_id, len(lines), len(lines) - len(kept), digest] += 1
    return out


def run(docs):
    maps = line_dedup.keep_bitmaps(docs)
    got = (
        line_dedup._keyed(docs)
        .join(maps, ["d", "t"], "left")
        .select("doc_id", "text", "bitmap")
        .mapInArrow(line_dedup._apply, "doc_id long, n_lines long, n_dropped long, sha string")
    )
    return Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("target", [100, 2**24])
def test_lines(table, corpus, with_clashes, monkeypatch, target):
    """With small ranges a common line spans many tasks."""
    monkeypatch.setattr(line_dedup, "_TARGET", target)
    hot = "A line that Every document has"
    rows = [(i, t if i is None or i % 2 else f"{t}\n\t{hot}\r\n{hot.lower()}") for i, t in corpus(8)]
    rows += [(2000, "ÄÖÜäöüÄÖÜx"), (2001, "äÖÜäöüÄÖÜx"), (2002, "ÄÖÜäöüÄÖÜX"), (2003, "ÄÖÜäöüÄÖÜ")]
    assert run(with_clashes(table(rows))) == brute(rows)


def test_very_long_texts(table):
    """Texts of 600 KB that share every third line, and a line of 300 KB."""
    one, two = (
        "\n".join(f"line {i} of {'all' if i % 3 == 0 else d}" + "." * 10 for i in range(20_000))
        for d in (1, 2)
    )
    line = "ab " * 100_000
    rows = [(5, one), (4, two), (7, f"{line}\n{two}"), (8, line.upper())]
    assert run(table(rows)) == brute(rows)


def test_bitmap_reaches_beyond_its_end():
    keep = line_dedup.read_bitmap(None, 3)
    assert keep.tolist() == [True] * 3


def test_empty(table):
    assert line_dedup.keep_bitmaps(table([])).count() == 0
