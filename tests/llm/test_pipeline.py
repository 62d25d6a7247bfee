from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from paylens.llm import decontamination, mixing, quality
from tests.llm.test_exact_dedup import normal
from tests.llm.test_mixing import words
from tests.llm.test_near_dedup import brute as near_brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    """Every stage against plain code on its own input, over the supplied documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        out = corpus_pipeline.saved(stage(spark, docs, SF_DIR), "test-stage")
        after = [r.asDict() for r in out.collect()]
        ids = sorted(r["doc_id"] for r in after)
        if "quality" in name:
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            scored = quality.classify(docs, quality.fit(docs, labels)).collect()
            assert ids == sorted(r["doc_id"] for r in scored if r["predicted"] == 1)
        elif "exact" in name:
            first = {}
            for r in before:
                key = normal(r["text"])
                first[key] = min(first.get(key, r["doc_id"]), r["doc_id"])
            assert ids == sorted(first.values())
        elif "near" in name:
            verdicts = near_brute([(r["doc_id"], r["text"]) for r in before], 80)
            assert ids == sorted(v[0] for v in verdicts if v[3])
        elif "benchmark" in name:
            benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            found = decontamination.leaks(docs, benchmark, **decontamination.WHOLE)
            flagged = {r["doc_id"] for r in found.collect()}
            assert ids == sorted({r["doc_id"] for r in before} - flagged)
            passages = [r["text"] for r in benchmark.collect()]
            assert not any(p in (r["text"] or "") for r in after for p in passages)
        else:
            taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
            assert Counter(ids) == +Counter(taken)
            assert out.columns == [*columns, "mix_copy"]
            assert 1.3 < sum(words(r["text"]) for r in after) / sum(words(r["text"]) for r in before) < 1.7
            continue
        assert out.columns == columns and ids
        docs = out


@pytest.fixture(scope="module")
def odd_dir(spark, table, corpus, with_clashes, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    with_clashes(table(corpus(41))).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        [(1, 1, 0), (3, 1, 0), (None, 1, 1), (6, None, 0)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "x y")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return str(folder)


def test_odd_rows(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    given = Counter((r.doc_id, r.text) for r in docs.collect())
    out = corpus_pipeline.run(spark, odd_dir)
    assert out.columns == [*docs.columns, "mix_copy"]
    taken = Counter((r.doc_id, r.text) for r in out.collect())
    assert taken and set(taken) <= set(given) and max(taken.values()) <= 2
    kept = {}
    for doc_id, text in taken:  # one row of each text
        assert kept.setdefault(normal(text), (doc_id, text)) == (doc_id, text)
    for key, (doc_id, _) in kept.items():  # that with the smallest id, if it was not rejected with others
        same = [d for d, t in given if normal(t) == key and d is not None]
        assert doc_id is None or doc_id in same


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("given", [None, "1m"])
def test_python_gets_small_batches(spark, monkeypatch, given):
    """24 MB of one partition reach Python in batches of 4 MB, or of what the session asks for."""

    def sizes(docs, labels):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        return docs.select("text").mapInArrow(run, "n long")

    monkeypatch.setattr(corpus_pipeline, "keep_good", sizes)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('x', 8000) AS text")
    before = spark.conf.get(corpus_pipeline.BATCH, None)
    spark.conf.set(corpus_pipeline.BATCH, given) if given else spark.conf.unset(corpus_pipeline.BATCH)
    try:
        found = [r["n"] for r in corpus_pipeline.quality_stage(spark, docs, SF_DIR).collect()]
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before) if before else spark.conf.unset(corpus_pipeline.BATCH)
    assert sum(found) > 3000 * 8000
    assert max(found) < (2**20 if given else corpus_pipeline.BATCH_BYTES) + 100_000
