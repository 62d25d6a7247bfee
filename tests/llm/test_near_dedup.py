from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from paylens.llm import near_dedup
from paylens.llm.near_dedup import components, keep_one, similar_components

LAST = 2**63 - 1


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                top[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), LAST), LAST if doc_id is None else doc_id)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        comp = low[find(i)] if sets[i] else doc_id
        comp = None if comp == LAST else comp
        out[doc_id, len(sets[i]), comp, doc_id == comp] += 1
    return out


def run(docs, **options):
    got = similar_components(docs, **options).drop("at", "text_hash")
    return Counter(map(tuple, got.collect()))


def grown(seed, n, words=120, edits=6):
    """Families of near copies, some of them chains, with similarities around the threshold."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if not rows or rng.random() < 0.25:
            text = [f"v{rng.randrange(2000)}" for _ in range(rng.randrange(words // 2, words))]
        else:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(len(text))] = f"v{rng.randrange(2000)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_small_nodes(table, corpus, with_clashes, percent):
    rows = grown(1, 150) + [(None if i is None else i + 500, t) for i, t in corpus(21, n=60)]
    got = run(with_clashes(table(rows)), similarity=percent / 100)
    assert got == brute(rows, percent)


@pytest.mark.parametrize("levels", [1, 3])
def test_oversized_nodes(table, levels):
    """Nodes of over four members branch again, or are compared in blocks beyond the last level."""
    rows = grown(2, 120, edits=4)
    got = run(table(rows), leaf=4, levels=levels, trees=6)
    assert got == brute(rows, 85)


def test_large_group(table):
    rng = random.Random(5)
    base = [f"b{rng.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(200)] = f"x{rng.randrange(900)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, t) for i, t in grown(6, 30)]
    assert run(table(rows), leaf=16) == brute(rows, 85)


def test_components(spark):
    links = [(f"{i:04d}", f"{i + 1:04d}") for i in range(0, 60)] + [("9000", "9001"), ("9002", "9001")]
    rng = random.Random(1)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    given = spark.createDataFrame([(a.encode(), b.encode()) for a, b in links], "a binary, b binary")
    found = {bytes(r["c"]): bytes(r["comp"]) for r in components(given).collect()}
    assert found[b"0060"] == found[b"0030"] == b"0000" and found[b"9002"] == b"9000"


def test_one_of_each_stays(table, with_clashes):
    rows = [(i, t) for i, t in grown(3, 80)]
    docs = with_clashes(table(rows))
    out = keep_one(docs)
    assert out.columns == docs.columns
    kept = {k[0] for k, _ in brute(rows, 85).items() if k[3]}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept)


def test_empty(table):
    assert similar_components(table([])).count() == 0
    assert run(table([(1, None), (2, " ")])) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})


def test_stated_miss_rates():
    for similarity in (0.8, 0.85, 0.9):
        least = near_dedup.least_equal(similarity)
        rng = np.random.default_rng(1)
        equal = rng.binomial(near_dedup.COORDINATES, similarity, 2_000_000)
        assert (equal < least).sum() <= 3  # 0.12 below the threshold lost hundreds at 0.8
        # All levels that branch twice keep within a few times the miss rate of the first.
        for level in range(2, near_dedup.DOUBLED + 2):
            assert near_dedup.miss_rate(similarity, level) < 4 * near_dedup.miss_rate(similarity)


def test_pairs_just_above_the_threshold_with_low_sketches():
    n = 400
    least = near_dedup.least_equal(0.8)
    sketch = np.zeros((2, near_dedup.COORDINATES), np.uint8)
    sketch[1, least:] = 1
    node = {"sketch": sketch, "n": np.array([n, n]), "comp": np.array([0, 1])}
    assert [(i, list(j)) for i, j in near_dedup._candidates(node, 0.8, None)] == [(0, [1])]
    assert list(near_dedup._candidates(node, 0.8, 0.12)) == []
