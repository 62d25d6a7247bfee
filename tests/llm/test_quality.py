from __future__ import annotations

import zlib

import numpy as np
import pytest

from paylens.llm import quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")


def scores(docs, labels):
    got = quality.classify(docs, quality.fit(docs, labels)).collect()
    return {r["doc_id"]: r for r in got}


def test_held_out_accuracy_and_no_leak(spark, given):
    docs, labels = given
    found = scores(docs, labels)
    rows = labels.collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {i for i, r in found.items() if r["held_out"]} == {
        i for i in found if zlib.crc32(str(i).encode()) % 3 == 1
    }
    right = np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in held])
    assert right > 0.95
    # Labels of the held-out fold, and the other columns, have no influence.
    ids = [r["doc_id"] for r in held]
    turned = labels.withColumn(
        "quality", quality.F.when(labels.doc_id.isin(ids), 1 - labels.quality).otherwise(labels.quality)
    )
    blank = docs.withColumn("lang", quality.F.lit(None)).withColumn("source", quality.F.lit("x"))
    again = scores(blank, turned)
    assert all(again[i]["score"] == r["score"] for i, r in found.items())


def test_odd_rows(spark, given, table, with_clashes):
    _, labels = given
    docs, _ = given
    model = quality.fit(docs, labels)
    rows = [(1, None), (2, ""), (None, "the of and"), (3, "The " * 200_000), (3, "x"), (3, "x")]
    got = quality.classify(with_clashes(table(rows)), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    kept = quality.keep_good(with_clashes(table(rows)), labels.limit(0))
    assert kept.count() == 6  # nothing is known: the smoothed share is one half
    assert quality.classify(table([]), model).count() == 0


def test_few_labels(spark, table):
    docs = table([(i, f"word{i} and more") for i in range(20)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 0, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert len({r["score"] for r in got}) == 1 and got[0]["score"] > 0.5


def test_the_filter_scores_every_slice_of_a_batch(spark, monkeypatch):
    words = quality.Vectors(["good", "bad"], np.eye(2, quality.WORD_DIM))
    model = quality.Model(words, quality.shape_vectors())
    texts = ["good good word", "bad word bad"]
    x = model.features(texts * 40, quality.Shapes(model.shapes))
    y = np.array([1.0, 0.0] * 40)
    model.network = quality.Network(x.astype(np.float64), y, np.zeros(80, bool))
    monkeypatch.setattr(quality, "fit", lambda *_, **__: model)
    rows = spark.range(3000).selectExpr(
        "id AS doc_id", f"IF(id % 3 = 0, '{texts[0]}', '{texts[1]}') AS text"
    )
    kept = {r["doc_id"] for r in quality.keep_good(rows.coalesce(1), None).collect()}
    assert kept == set(range(0, 3000, 3))
