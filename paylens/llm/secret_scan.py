"""Secret scan: fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over the characters of tokens are trained on the documents
themselves. Labelled samples are at hand there: what the patterns match is random text, and
all other runs of token characters are ordinary words and identifiers, but for long ones with digits
in their midst, which have no label. Few corpora hold keys of every kind behind a pattern, so random
text may also be uniform over the smallest usual alphabet that holds the token; the likelier of the two
counts. Ordinary text may also repeat a character. Every run of ``LEAST_TOKEN`` token characters or more
outside the matches, also beside one in the same token, is a secret when the log-likelihood ratio, in
total and per character, is high; runs of digits alone are numbers. The least total of a length is
``LEAST_TOTAL``, or higher where clearly more than ``FALSE_ALARMS`` of the corpus's runs of that length
would be words (letters in one case, also joined) that exceed it. Training counts every text, twice; what is kept
is one count per pair of characters, and per length and total.

Defined cases: a null or empty text has no spans; with no labelled random text at all the random
models are uniform; any text length works.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import id_and_text, read_table

# The patterns, in the order in which kinds are listed, and the least lengths.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "markov"]

# The method's own limits.
LEAST_TOKEN = 8  # characters of a run that is scored
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}={{0,2}}")
UNLABELLED = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
IDENTIFIER = re.compile(r"[A-Za-z_-]+[0-9]{0,4}")  # ordinary, whatever its length
WORDS = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[/_-]+(?:[A-Z]?[a-z]+|[A-Z]+))*[0-9]{0,4}")  # certain ones
LEAST_TOTAL = 9.0  # natural log-likelihood ratio of the whole token: one secret in some 10,000 tokens
FALSE_ALARMS = 1e-4  # part of the runs of one length that may be words judged secret
CHANCE = 5  # as many say nothing about a rate; random keys of letters in one case look like words
LENGTHS, TOTALS = 64, 256  # longer runs, and higher totals, count as these
REPEATED = 0.1  # chance of an ordinary character to be the one before it
LEAST_MEAN = 0.6  # and per character
PRIOR = 20.0  # weight of a character's frequency against what is counted after another one

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_SIZE = len(ALPHABET) + 1
_EDGE = len(ALPHABET)  # any other character, and the ends of a token
_CODE = np.full(256, _EDGE, np.uint8)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
# Alphabets of random keys, each but the last with the bit that says a character is outside of it.
_HEX, _LOWER, _UPPER = "0123456789abcdef", ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62]
_KEYS = [_HEX, _HEX.upper(), _LOWER, _UPPER, ALPHABET[:62], ALPHABET]
_OUTSIDE = np.array(
    [sum((c not in a) << k for k, a in enumerate(_KEYS[:-1])) for c in ALPHABET] + [(1 << len(_KEYS) - 1) - 1],
    np.uint8,
)
# By the bits of a run's characters together: log-probability of a character in the smallest that fits.
_UNIFORM = np.array(
    [max(-np.log(len(a)) for k, a in enumerate(_KEYS) if not bits >> k & 1) for bits in range(1 << len(_KEYS) - 1)]
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def unlabelled(text: str) -> Iterator[re.Match]:
    """Long tokens of digits and other characters: in neither model's sample."""
    for m in UNLABELLED.finditer(text):
        if not m[0].isdigit() and any(c.isdigit() for c in m[0]):
            yield m


def runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the models are to judge: tokens, or what sorted spans taken from them leave."""
    found = [m.span() for m in TOKEN.finditer(text)]
    if not taken:
        return found
    out, first = [], 0
    for start, end in found:
        while first < len(taken) and taken[first][1] <= start:
            first += 1
        at, i = start, first
        while i < len(taken) and taken[i][0] < end:
            out.append((at, taken[i][0]))
            at = max(at, taken[i][1])
            i += 1
        out.append((at, end))
    return [(s, e) for s, e in out if e - s >= LEAST_TOKEN]


def pair_counts(texts: list[str]) -> np.ndarray:
    """Counts of adjacent characters: [0] in matched values, [1] in all else that is labelled."""
    both = np.zeros((2, _SIZE * _SIZE), np.int64)
    for text in texts:
        base, at, rest = base_spans(text), 0, []
        random = [ASSIGN.match(text, s)[2] if kind == 0 else text[s:e] for s, kind, e in base]
        unknown = [m.span() for m in unlabelled(text) if not IDENTIFIER.fullmatch(m[0])]
        left_out = sorted([(s, e) for s, _, e in base] + unknown)
        for start, end in left_out:
            rest.append(text[at : max(at, start)])
            at = max(at, end)
        rest.append(text[at:])
        for row, joined in enumerate((" ".join(random), " ".join(rest))):
            codes = _CODE[np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)].astype(np.int32)
            codes = np.concatenate([[_EDGE], codes, [_EDGE]])
            both[row] += np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE)
    return both


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, _SIZE * _SIZE), np.int64)
    for batch in batches:
        total += pair_counts(batch["text"].to_pylist())
    model, pair = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(model), pa.array(pair), pa.array(total[model, pair])], ["model", "pair", "n"]
    )


class Models:
    """What a run's score takes: log-probabilities of pairs of characters, and least totals by length."""

    def __init__(self, learned: np.ndarray, ordinary: np.ndarray, least: np.ndarray):
        self.ordinary, self.ratio, self.least = ordinary, learned - ordinary, least

    def scores(self, text: str, found: list[tuple[int, int]]) -> np.ndarray:
        """Log-likelihood ratio over the characters of each run, its ends not counted."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.array(found)
        sizes = bounds[:, 1] - bounds[:, 0]
        offsets = np.cumsum(sizes) - sizes
        inside = np.repeat(bounds[:, 0] - offsets, sizes) + np.arange(sizes.sum())
        codes = _CODE[np.minimum(points[inside], 255)].astype(np.int32)
        pairs = codes[:-1] * _SIZE + codes[1:]
        pairs = np.append(pairs, 0)  # the pair behind a run's last character is not its own
        first, last = offsets, offsets + sizes - 1
        ratio = np.concatenate([[0.0], np.cumsum(self.ratio[pairs])])
        ordinary = np.concatenate([[0.0], np.cumsum(self.ordinary[pairs])])
        uniform = _UNIFORM[np.bitwise_or.reduceat(_OUTSIDE[codes], offsets)] * (sizes - 1)
        return np.maximum(ratio[last] - ratio[first], uniform - (ordinary[last] - ordinary[first]))


def train(docs: DataFrame, total: float = LEAST_TOTAL, alarms: float = FALSE_ALARMS) -> Models:
    """Both models, then the least totals that they need on the words of the documents.

    The driver receives two counts per pair of characters and per length and total at most, whatever
    the input.
    """
    texts = id_and_text(docs).select("text")
    counts = np.zeros((2, _SIZE * _SIZE))
    for row in _summed(texts.mapInArrow(_count, "model long, pair long, n long"), "model", "pair"):
        counts[row["model"], row["pair"]] = row["n"]
    models = Models(*log_models(counts), np.full(LENGTHS + 1, total))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((LENGTHS + 1, TOTALS + 1), np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                _judged(models, text, total, seen)
        size, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(size), pa.array(bucket), pa.array(seen[size, bucket])], ["size", "bucket", "n"]
        )

    seen = np.zeros((LENGTHS + 1, TOTALS + 1))
    for row in _summed(texts.mapInArrow(judge, "size long, bucket long, n long"), "size", "bucket"):
        seen[row["size"], row["bucket"]] = row["n"]
    models.least = least_totals(seen, total, alarms)
    return models


def _summed(counted: DataFrame, *by: str) -> list:
    return counted.groupBy(*by).agg(F.sum("n").alias("n")).collect()


def _judged(models: Models, text: str, total: float, seen: np.ndarray) -> None:
    """Adds a text's runs to the counts: [length, 0] all, [length, b] words of a total above b - 1."""
    found = runs(text, _taken(base_spans(text)))
    if not found:
        return
    scores = models.scores(text, found)
    sizes = np.minimum([end - start for start, end in found], LENGTHS)
    seen[:, 0] += np.bincount(sizes, minlength=LENGTHS + 1)
    for i in np.flatnonzero(scores >= total):
        if WORDS.fullmatch(text, *found[i]):
            seen[sizes[i], min(int(scores[i]) + 1, TOTALS)] += 1


def least_totals(seen: np.ndarray, total: float, alarms: float) -> np.ndarray:
    """By length, the least whole total that no more words exceed than the given part of all runs allows."""
    above = np.cumsum(seen[:, :0:-1], axis=1)[:, ::-1]  # words of a total of b or more, b from 0
    expected = alarms * seen[:, :1]
    few = above <= expected + 3 * np.sqrt(expected) + CHANCE
    few[:, -1] = True
    return np.maximum(total, few.argmax(axis=1))


def log_models(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Random and ordinary, each pair smoothed by the frequency of its second character.

    Without any labelled random text that model is uniform.
    """
    pairs = counts.reshape(2, _SIZE, _SIZE).astype(np.float64)
    single = pairs.sum(axis=1) + 1.0
    single /= single.sum(axis=1, keepdims=True)
    given = pairs + PRIOR * single[:, None, :]
    given /= given.sum(axis=2, keepdims=True)
    given[1] = (1 - REPEATED) * given[1] + REPEATED * np.eye(_SIZE)
    learned, ordinary = np.log(given).reshape(2, -1)
    return learned, ordinary


def _taken(base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What sorted spans cover, without overlaps; one may lie within another."""
    taken: list[tuple[int, int]] = []
    for start, _, end in base:
        if not taken or end > taken[-1][1]:
            taken.append((max(start, taken[-1][1]) if taken else start, end))
    return taken


def scan_text(models: Models, text: str, mean=LEAST_MEAN):
    """The result columns of one text, without doc_id."""
    base, extra = base_spans(text), []
    found = runs(text, _taken(base))
    if found:
        scores = models.scores(text, found)
        lengths = np.array([end - start for start, end in found])
        least = np.maximum(models.least[np.minimum(lengths, LENGTHS)], mean * (lengths - 1))
        for i in np.flatnonzero(scores >= least):
            start, end = found[i]
            if not text[start:end].isdigit():
                extra.append((start, 3, end))

    def joined(spans):
        return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)

    counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return (*counts, digest, joined(sorted(base + extra)), len(extra))


_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_markov long"
)


def secret_scan(docs: DataFrame, total: float = LEAST_TOTAL, mean: float = LEAST_MEAN) -> DataFrame:
    """One row per document: counts per kind, digest of the patterns' spans, and all spans.

    Spans are kind:start:end in code points, the end not included.
    """
    models = train(docs, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(models, t, mean) for t in batch["text"].to_pylist()]
            cols = list(zip(*rows)) or [[] for _ in range(6)]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"],
            )

    return id_and_text(docs).mapInArrow(run, _SCHEMA)


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents"))
