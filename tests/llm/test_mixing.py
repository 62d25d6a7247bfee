from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from paylens.llm.mixing import MOST, SHARE, WEIGHTS, mix, mix_documents


def filled(sizes):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    left, open_, target = SHARE * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > MOST * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = MOST * sizes[s]
            open_.discard(s)
        left = SHARE * sum(sizes.values()) - sum(target.values())
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def mixed_rows(corpus):
    rows = corpus(1, n=400)
    names = ["a", "B", "é", None, "z", "hot", "hot", "hot", "none"]
    return [(i, None if names[k % 9] == "none" else t, names[k % 9]) for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("group", [2, 32])
def test_targets_and_taken(table, mixed_rows, group):
    got = mix(table(mixed_rows), group=group).collect()
    sizes, largest = Counter(), Counter()
    for _, text, source in mixed_rows:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    expected = filled(dict(sizes))
    taken = defaultdict(int)
    for row in got:
        assert row["target"] == pytest.approx(expected[row["source"]])
        assert row["source_size"] == sizes[row["source"]]
        assert 0 <= row["copies"] <= 2
        taken[row["source"]] += row["copies"] * row["size"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source]
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(
        (i, s, words(t)) for i, t, s in mixed_rows
    )


def test_reruns_agree(table, mixed_rows):
    columns = ["doc_id", "source", "size", "copy", "copies"]
    first = sorted(map(repr, mix(table(mixed_rows)).select(columns).collect()))
    again = sorted(map(repr, mix(table(mixed_rows[::-1], partitions=7)).select(columns).collect()))
    assert first == again


def test_draws_are_fair(table):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(100)]
    seen = Counter()
    for seed in range(12):
        for row in mix(table(rows), seed=seed, group=8).filter("source = 'b'").collect():
            seen[row["doc_id"]] += row["copies"]
    target = filled({"a": sum(1 + i % 5 for i in range(0, 100, 2)), "b": sum(1 + i % 5 for i in range(1, 100, 2))})
    share = target["b"] / sum(1 + i % 5 for i in range(1, 100, 2))
    assert sum(seen.values()) / (12 * 50) == pytest.approx(share, abs=0.06)
    assert 0 < min(Counter(seen.values()))


def test_documents_are_repeated(table, mixed_rows, with_clashes):
    docs = with_clashes(table(mixed_rows))
    out = mix_documents(docs)
    assert out.columns == [*docs.columns, "mix_copy"]
    expected = Counter()
    for row in mix(docs).collect():
        expected[row["doc_id"], row["source"], row["size"]] += row["copies"]
    got = Counter((r["doc_id"], r["source"], words(r["text"])) for r in out.collect())
    assert got == +expected


def test_empty(table):
    assert mix(table([])).count() == 0
    assert mix_documents(table([])).count() == 0
