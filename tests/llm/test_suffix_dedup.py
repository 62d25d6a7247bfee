from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from paylens.llm import suffix_dedup
from paylens.llm.common import saved
from pyspark.sql import functions as F

LAST = 2**63 - 1


def test_suffix_array_and_repeats():
    rng = random.Random(3)
    for _ in range(200):
        letters = rng.choice([b"ab", b"abc", b"a", b"abcdefgh\x00"])
        contexts = [
            bytes(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
            for _ in range(rng.randrange(1, 9))
        ]
        contexts = list(dict.fromkeys(contexts))
        length = rng.choice([3, 5, 9, 16])
        text = b"".join(bytes(x + 1 for x in c) + b"\0" for c in contexts)
        rest = [len(c) - i for c in contexts for i in range(len(c) + 1)]
        wanted = np.array(rest) >= length
        order = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8), wanted, length)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        prefixes = [text[i : text.index(b"\0", i) + 1][:length] for i in order.tolist()]
        assert prefixes == sorted(prefixes)

        places = np.array([(rng.randrange(4), 0, rng.randrange(30)) for _ in contexts], np.int64)
        starts = defaultdict(list)
        for c, context in enumerate(contexts):
            for i in range(len(context) - length + 1):
                place = (places[c][0], places[c][2] + i)
                starts[context[i : i + length]].append((place, c, i))
        expected = {
            (c, i + k)
            for found in starts.values()
            for place, c, i in found
            if place > min(found)[0]
            for k in range(length)
        }
        got = {
            (c, x)
            for c, s, e in suffix_dedup.repeated_strings(contexts, places, length).tolist()
            for x in range(s, e)
        }
        assert got == expected


def test_equal_strings_have_the_same_anchor():
    rng = random.Random(4)
    for _ in range(30):
        texts = [
            bytes(rng.choice(b"ab ") for _ in range(rng.randrange(400)))
            if rng.random() < 0.5
            else rng.randbytes(rng.randrange(300))
            for _ in range(6)
        ]
        texts += [texts[0] + texts[1], b"The " * 200]
        anchor = {}
        for i, s, e, h in zip(*(x.tolist() for x in suffix_dedup.anchors(texts))):
            for start in range(s, e - 99):
                assert (i, start) not in anchor
                anchor[i, start] = h
        assert len(anchor) == sum(max(0, len(t) - 99) for t in texts)
        seen = defaultdict(set)
        for (i, start), h in anchor.items():
            seen[texts[i][start : start + 100]].add(h)
        assert all(len(x) == 1 for x in seen.values())


def brute(rows, length):
    """Result rows by looking every string up; order: doc_id, then the hash column of the text."""
    distinct = sorted({(LAST if i is None else i, t, text.encode()) for i, t, text in rows})
    seen, removed = {}, {}
    for d, t, data in distinct:
        for s in range(len(data) - length + 1):
            seen.setdefault(data[s : s + length], (d, t, s))
        covered = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if seen[data[s : s + length]] != (d, t, s):
                covered[s : s + length] = True
        removed[d, t] = covered
    out = Counter()
    for i, t, text in rows:
        covered = removed[LAST if i is None else i, t]
        kept = bytes(np.frombuffer(text.encode(), np.uint8)[~covered])
        spans = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
        digest = hashlib.sha256(kept).hexdigest()
        out[i, len(covered), int(covered.sum()), spans, digest] += 1
    return out


def run(docs, **options):
    spans = saved(suffix_dedup.repeated_spans(docs, **options), "test-spans")
    grouped = spans.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    got = (
        suffix_dedup._keyed(docs)
        .join(grouped, ["d", "t"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(suffix_dedup._remove, "i long, n long, r long, s long, h string")
    )
    keyed = [tuple(r) for r in suffix_dedup._keyed(docs).select("doc_id", "t", "text").collect()]
    return Counter(map(tuple, got.collect())), keyed


@pytest.mark.parametrize(
    "options",
    [{}, {"length": 40, "block": 2000, "size": 3000, "shard": 3000}, {"length": 40, "crowd": 2}],
)
def test_documents(table, corpus, with_clashes, options):
    rows = [(i, t if not t or len(t) < 9000 else t[:9000]) for i, t in corpus(11, n=50)]
    rows += [(5000 + i, f"{i} " + "passage that many documents share " * 5 + f" {i}") for i in range(9)]
    got, keyed = run(with_clashes(table(rows)), **options)
    assert got == brute(keyed, options.get("length", 100))


def test_blocks_that_are_not_found_again(table, corpus, monkeypatch):
    """Then every anchor counts as repeated, with the same result."""
    rows = corpus(12, n=30)[:30]
    monkeypatch.setattr(suffix_dedup, "_store_repeated", lambda store: lambda it: (b.select(["block"]) for b in it))
    got, keyed = run(table(rows), length=40)
    assert got == brute(keyed, 40)


def test_supplied_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got, keyed = run(docs)
    assert got == brute(keyed, 100)


def test_empty(table):
    assert run(table([]))[0] == Counter()
