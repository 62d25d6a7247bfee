from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from paylens.llm import exact_dedup
from paylens.llm.common import scratch


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, kept = min(known, default=None), False
        for doc_id in ids:
            first = doc_id == keep and not kept
            kept = kept or first
            out[doc_id, keep, len(ids), first] += 1
    return out


@pytest.mark.parametrize("digits", [64, 1])
def test_groups(table, corpus, with_clashes, digits):
    rows = corpus(5) + [(70 + i, " same\n\ttext ") for i in range(40)] + [(69, " same text ")]
    got = exact_dedup.exact_groups(with_clashes(table(rows)), digits=digits)
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect())
    assert found == brute(rows)


def test_digest(table):
    (row,) = exact_dedup.exact_groups(table([(3, "a \n b")])).collect()
    assert row["digest"] == hashlib.sha256(b"a b").hexdigest()


def test_state_outlives_a_run(spark, table):
    """A second run over more files goes on from the state of the first."""
    folder = exact_dedup.arrive(table([(5, "a"), (6, "b"), (7, "a")]), 64)
    checkpoint = scratch(spark, "state")
    exact_dedup.digest_state(spark, folder, checkpoint, files_per_batch=1)
    more = exact_dedup.arrive(table([(2, "a"), (9, "c")]), 64)
    spark.read.parquet(more).write.mode("append").parquet(folder)
    state = exact_dedup.digest_state(spark, folder, checkpoint, files_per_batch=1)
    found = {(r["first_id"], r["n"]) for r in state.collect()}
    assert found == {(2, 3), (6, 1), (9, 1)}


def test_kept_rows(table, corpus, with_clashes):
    rows = corpus(6)
    docs = with_clashes(table(rows))
    out = exact_dedup.keep_first(docs)
    assert out.columns == docs.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    expected = Counter()
    for (doc_id, _, _, first), n in brute(rows).items():
        expected[doc_id] += n * first
    assert kept == +expected


def test_empty(table):
    assert exact_dedup.exact_groups(table([])).count() == 0
    assert exact_dedup.keep_first(table([])).count() == 0
