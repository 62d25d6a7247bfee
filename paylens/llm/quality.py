"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every token has a sparse random index vector, a hash of the token. A word's vector is the sum of
the index vectors of its neighbours in the training texts plus its own; words that the training
texts lack share one empty vector. Beside its words, a text is read as a second sequence, the
shapes of its tokens (lower case, capitalised, marks, a repeat of the token before, ...), with
vectors of its own. A document is pooled from whole texts: the mean of its word vectors, and of
its shape vectors the mean, and the highest and lowest mean of any stretch of 64 tokens. A two-layer
numpy network scores the pooled vector; its logits are divided by a temperature fitted on labelled
documents that took no part in the gradient steps, so that scores are probabilities.

Labels of the fold crc32(doc_id) mod 3 = 1 are never read. At most ``sample`` labelled documents
(those with the smallest hash of their doc_id) are used to fit, so the model's size is bounded;
every document is scored over its whole text.

Defined cases: a null or empty text is scored from an empty pool; a null doc_id is not held out
and has no label; several labels of one doc_id are averaged; without labels, or with labels of
one kind only, every score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import id_and_text, order_key, read_table, saved

SAMPLE = 8000  # labelled documents used to fit
LEAST_DOCS = 3  # training documents that must hold a word for it to get a vector
WORD_DIM, SHAPE_DIM = 32, 16
WIDTH = WORD_DIM + 3 * SHAPE_DIM + 2  # of a pooled document
STRETCH = 64  # tokens
HIDDEN = 32
EPOCHS = 60

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SHAPES = ["lower", "title", "upper", "digits", "mixed", "repeat"]


def shape(token: str) -> str:
    if token.isalpha():
        if token.islower():
            return "lower"
        return "upper" if token.isupper() and len(token) > 1 else "title"
    if token.isdigit():
        return "digits"
    return token[:4] if not token[0].isalnum() else "mixed"


def index_vector(token: str, dim: int) -> np.ndarray:
    """A sparse ternary vector that depends on the token alone."""
    rng = np.random.default_rng(zlib.crc32(token.encode("utf-8", "replace")))
    vector = np.zeros(dim, np.float32)
    vector[rng.permutation(dim)[:8]] = [1, -1, 1, -1, 1, -1, 1, -1]
    return vector


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text)


class Vectors:
    """Vectors of a bounded set of tokens; row 0 is for all others."""

    def __init__(self, names: list[str], table: np.ndarray):
        self.ids = {name: i + 1 for i, name in enumerate(names)}
        empty = np.zeros((1, table.shape[1]), np.float32)
        self.table = np.vstack([empty, table.astype(np.float32)])

    def rows(self, names: list[str]) -> np.ndarray:
        get = self.ids.get
        return np.array([get(n, 0) for n in names], np.int32)


class Shapes:
    """Shape numbers of tokens without a vector, remembered up to a bound."""

    def __init__(self, shapes: Vectors, bound: int = 50_000):
        self.ids, self.known, self.bound = shapes.ids, {}, bound

    def of(self, tokens: list[str]) -> list[int]:
        known, out = self.known, []
        if len(known) > self.bound:
            known.clear()
        for token in tokens:
            form = known.get(token)
            if form is None:
                form = known[token] = self.ids.get(shape(token), 0)
            out.append(form)
        return out


def _forms(model: Model, memo: Shapes, tokens: list[str], ids: np.ndarray) -> np.ndarray:
    """Shape number of every token; one that repeats the token before it has its own."""
    forms = model.shape_of[ids]
    rare = np.flatnonzero(ids == 0)
    forms[rare] = memo.of([tokens[i] for i in rare.tolist()])
    again = ids[1:] == ids[:-1]
    for i in np.flatnonzero(again & (ids[1:] == 0)).tolist():
        again[i] = tokens[i] == tokens[i + 1]
    forms[1:][again] = model.shapes.ids["repeat"]
    return forms


def pooled(model: Model, memo: Shapes, text: str) -> np.ndarray:
    tokens = tokens_of(text)
    if not tokens:
        return np.zeros(WIDTH, np.float32)
    words, shapes = model.words, model.shapes
    ids = words.rows(tokens)
    counts = np.bincount(ids)
    present = np.flatnonzero(counts)
    mean = (counts[present].astype(np.float32) @ words.table[present]) / len(ids)
    known = 1 - counts[0] / len(ids)
    rows = shapes.table[_forms(model, memo, tokens, ids)]
    starts = np.arange(0, len(rows), STRETCH)
    sums = np.add.reduceat(rows, starts, axis=0)
    means = sums / np.diff(np.append(starts, len(rows)))[:, None]
    whole = sums.sum(axis=0) / len(rows)
    size = [known, np.log1p(len(tokens)) / 10]
    return np.concatenate([mean, whole, means.max(axis=0), means.min(axis=0), size]).astype(np.float32)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word of these texts: documents, and the sum of its neighbours' index vectors."""
    docs: Counter = Counter()
    ids: dict[str, int] = {}
    index, sums = np.zeros((1024, WORD_DIM), np.float32), np.zeros((1024, WORD_DIM))
    for batch in batches:
        for text in batch["text"].to_pylist():
            tokens = tokens_of(text)
            for token in tokens:
                if token not in ids:
                    if len(ids) == len(index):
                        index = np.vstack([index, np.zeros_like(index)])
                        sums = np.vstack([sums, np.zeros_like(sums)])
                    index[len(ids)] = index_vector(token, WORD_DIM)
                    ids[token] = len(ids)
            docs.update(set(tokens))
            at = np.array([ids[t] for t in tokens], np.int64)
            near = index[at]
            both = np.zeros_like(near)
            for distance in (1, 2):
                both[distance:] += near[:-distance]
                both[:-distance] += near[distance:]
            order = np.argsort(at, kind="stable")
            present, starts = np.unique(at[order], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(both[order], starts, axis=0)
    for start in range(0, len(ids), 10_000):
        names = list(ids)[start : start + 10_000]
        rows = sums[start : start + len(names)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([docs[n] for n in names]), pa.array(list(rows))],
            ["token", "docs", "v"],
        )


def word_vectors(texts: DataFrame, least_docs: int = LEAST_DOCS) -> Vectors:
    """Random-indexing vectors of the words in at least ``least_docs`` of the sampled texts."""
    parts = texts.select("text").mapInArrow(_contexts, "token string, docs long, v array<double>")
    total = parts.groupBy("token").agg(
        F.sum("docs").alias("docs"),
        *(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(WORD_DIM)),
    )
    rows = total.filter(F.col("docs") >= least_docs).toArrow()  # bounded: words of the sample
    names = rows["token"].to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    names = [names[i] for i in order]
    table = np.stack([rows[f"v{i}"].to_numpy() for i in range(WORD_DIM)], axis=1)[order]
    for i, name in enumerate(names):
        table[i] += index_vector(name, WORD_DIM)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    return Vectors(names, table)


def shape_vectors() -> Vectors:
    """Index vectors of the shapes; marks up to four characters have their own."""
    marks = [m * n for m in "!#$%&*|.,-_=+/\\@?:;()\"'" for n in (1, 2, 3, 4)]
    marks += [a + b * n for a in ".,;:" for b in "!#$%&*" for n in (1, 2, 3)]
    names = _SHAPES + marks
    return Vectors(names, np.stack([index_vector("\0" + n, SHAPE_DIM) for n in names]))


class Network:
    """Two dense layers; inputs are standardised, logits divided by the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray, epochs: int = EPOCHS):
        self.prior = (y.sum() + 1) / (len(y) + 2)
        self.fitted = 0 < y[~held].sum() < (~held).sum()
        self.temperature = 1.0
        if not self.fitted:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        rng = np.random.default_rng(7)
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.b2 = np.zeros(HIDDEN), np.zeros(1)
        self.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1))
        self._descend(x[~held], y[~held], rng, epochs)
        if held.any():
            self._calibrate(self._logits(x[held]), y[held])

    def _descend(self, x, y, rng, epochs, batch=64, rate=3e-3, decay=1e-3) -> None:
        params = [self.w1, self.b1, self.w2, self.b2]
        moment = [np.zeros_like(p) for p in params]
        square = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(max(epochs, 4000 * batch // (len(x) * 10) + 1)):
            order = rng.permutation(len(x))
            for start in range(0, len(x), batch):
                rows = order[start : start + batch]
                hidden = np.maximum(x[rows] @ self.w1 + self.b1, 0)
                p = 1 / (1 + np.exp(-(hidden @ self.w2 + self.b2)[:, 0]))
                error = ((p - y[rows]) / len(rows))[:, None]
                back = (error @ self.w2.T) * (hidden > 0)
                grads = [x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
                step += 1
                for i, (param, grad) in enumerate(zip(params, grads)):
                    grad = grad + decay * param * (param.ndim == 2)
                    moment[i] = 0.9 * moment[i] + 0.1 * grad
                    square[i] = 0.999 * square[i] + 0.001 * grad**2
                    fair = np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8
                    param -= rate * moment[i] / (1 - 0.9**step) / fair

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return (np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2)[:, 0]

    def _calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        def loss(t: float) -> float:
            z = logits / t
            return float(np.mean(np.logaddexp(0, z) - y * z))

        self.temperature = min(np.geomspace(0.25, 8, 80), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        z = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


class Model:
    def __init__(self, words: Vectors, shapes: Vectors, network: Network | None = None):
        self.words, self.shapes, self.network = words, shapes, network
        self.shape_of = np.array([0] + [shapes.ids.get(shape(w), 0) for w in words.ids], np.int32)

    def features(self, texts: list[str], memo: Shapes) -> np.ndarray:
        rows = [pooled(self, memo, t) for t in texts]
        return np.stack(rows) if rows else np.zeros((0, WIDTH), np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    chosen = saved(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "label-sample")
    texts = saved(id_and_text(docs).join(chosen, "doc_id"), "labelled-texts")
    shapes = shape_vectors()
    words = word_vectors(texts)
    model = Model(words, shapes)
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Shapes(shared.value.shapes)
        for batch in batches:
            x = shared.value.features(batch["text"].to_pylist(), memo)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float32()))],
                ["doc_id", "label", "x"],
            )

    rows = (
        texts.select("doc_id", "label", "text")
        .mapInArrow(features, "doc_id long, label int, x array<float>")
        .toArrow()
        .sort_by("doc_id")
    )
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(-1, WIDTH)
    y = rows["label"].to_numpy().astype(np.float64)
    ids = rows["doc_id"].to_pylist()
    held = np.array([zlib.crc32(b"t%d" % i) % 8 == 0 for i in ids], bool)
    model.network = Network(x, y, held)
    return model


_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Shapes(shared.value.shapes)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = shared.value.features(part["text"].to_pylist(), memo)
                score = shared.value.network.score(x)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(score, pa.float64()),
                     pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = id_and_text(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, _SCHEMA)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of docs whose score is at least ``least``, with their columns.

    Rows that repeat a doc_id stay if the row's own text does.
    """
    model = fit(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = Shapes(shared.value.shapes)
        for texts in batches:
            scores = [np.zeros(0)]
            for start in range(0, len(texts), 1024):  # few texts at a time as Python strings
                x = shared.value.features(texts.slice(start, 1024).to_pylist(), memo)
                scores.append(shared.value.network.score(x))
            yield pa.array(np.concatenate(scores), pa.float64())

    return docs.filter(score(F.coalesce(F.col("text"), F.lit(""))) >= least)
