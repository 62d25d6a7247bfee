"""Perplexity under an interpolated modified Kneser-Ney n-gram model of any order from 2 on.

Counting. Texts are read in blocks of bounded size. A block sends its distinct n-grams, as hashes
of their words with counts, to shards by the context, the words before the last; contexts of nothing
but words so frequent that they would overfill a shard are dealt by the whole n-gram. A shard adds up
the n-grams of all blocks and writes them, and what follows each context, as sorted hash arrays into
the shared folder. Each distinct n-gram then counts once for the shorter one that it ends with: these go
on to the shards of the next lower order, down to single words, with the plain word counts and what
follows contexts spread over shards. So the model grows with the text, and no task holds more than
one block or one shard.

Scoring. Workers map the arrays into memory and look up a block's distinct n-grams of each order in
sorted order; documents are read once more, but nothing is shuffled. Arrays in a folder that is not
on a mounted file system are copied to a worker's own disk while it runs.

A word w after a context u has probability (c(uw) - D) / c(u) + g(u) p(w after u less its first word).
c are counts in the highest order, below it numbers of distinct words before; single words are
interpolated with the uniform distribution over all training words and one unknown word. Each order's
D depends on whether a count is 1, 2 or more, and is estimated from the numbers of counts 1 to 4
(0.5, 1 and 1.5 where these are too few). Every text begins with as many start states as a context
has words, and ends with an end token.

Defined cases: a null or empty text is one end token; a null doc_id is not held out; rows that
repeat count and are scored as often as they appear; with no training text all probabilities are
uniform; a very long text is a block of its own, held whole by one task. Words are told apart by 64-bit hashes, words in n-grams by 48 bits of them, n-grams by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import blocks, by_shard, dealt
from paylens.llm.common import delete, id_and_text, read_table, scratch, word_hashes
from paylens.llm.store import Store

ORDER = 2  # words of the longest n-grams; README has the figures of 3
BLOCK = 16 * 2**20  # bytes of text that a task works on at once
SHARD = 20 * 2**20  # bytes of text per shard
ADD = 0.1  # of the base score

_END = np.uint64(0x9AE16A3B2F90404F)
_START = np.uint64(0xC3A5C85C97CB3127)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(16)  # bits that n-grams leave out of a word's hash


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of words, given by their 48-bit hashes."""
    x = (first * _PAIR) ^ (second + (first >> np.uint64(7)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def keys_of(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams, given by the 48-bit hashes of their first, second, ... words."""
    keys = words[0]
    for word in words[1:]:
        keys = pair_keys(keys, word)
    return keys


def spread(context: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    """Which contexts consist of frequent words only."""
    out = np.isin(context[0], hot)
    for words in context[1:]:
        out &= np.isin(words, hot)
    return out


def key_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys * _PAIR >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def word_shards(words: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each word, by the 48 bits that pairs know too."""
    return (((words >> _SHORT) * _PAIR >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)


class Block:
    """Words of some documents, one after another, each document ended by the end token."""

    def __init__(self, texts: list[str]):
        parts, lengths = [], []
        for text in texts:
            words = text.encode("utf-8", "replace").lower().split()
            parts.append(word_hashes(words))
            parts.append(np.array([_END]))
            lengths.append(len(words) + 1)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.short = self.words >> _SHORT

    def grams(self, order: int) -> list[np.ndarray]:
        """For each word, the 48-bit hashes of the words up to it, the farthest first."""
        at = np.arange(len(self.short)) - np.repeat(self.starts, self.lengths)
        out = [self.short]
        for back in range(1, order):
            before = np.full_like(self.short, _START >> _SHORT)
            before[back:] = np.where(at[back:] < back, _START >> _SHORT, self.short[:-back])
            out.insert(0, before)
        return out


def _new(keys: np.ndarray) -> np.ndarray:
    """Where a key in a sequence differs from the one before."""
    new = np.empty(len(keys), bool)
    new[:1] = True
    new[1:] = keys[1:] != keys[:-1]
    return new


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and for each place the number of its key."""
    order = np.argsort(keys)
    new = _new(keys[order])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[order[new]], order[new], number


def _small(x: np.ndarray) -> bytes:
    """Counts as the narrowest integers that hold them, with the width in front."""
    top = int(x.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _six(x: np.ndarray) -> bytes:
    """48-bit hashes as six bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


_PARTS = "shard long, kind int, a binary, b binary, c binary, d binary"
_WORDS, _GRAMS, _AFTER, _TOTALS = 0, 1, 2, 3


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[] for _ in range(6)]
    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)], ["shard", "kind", "a", "b", "c", "d"]
    )


def _words_dealt(words: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple]:
    at = word_shards(words, shards)
    order = np.argsort(at, kind="stable")
    words, counts = words[order], counts[order]
    return [
        (shard, _WORDS, words[part].tobytes(), _small(counts[part]), None, None)
        for shard, part in dealt(at[order], shards)
    ]


def _grams_dealt(grams: list[np.ndarray], counts: np.ndarray, hot: np.ndarray, shards: int):
    """Rows of distinct n-grams for their shards: contexts, how many n-grams each has, last words."""
    if len(grams) == 1:
        at = word_shards(grams[0] << _SHORT, shards)
        context = grams[0]
    else:
        context, at = _places(grams, hot, shards)
    order = np.argsort((at.astype(np.uint64) << np.uint64(36)) | (context >> np.uint64(28)))
    grams, counts = [g[order] for g in grams], counts[order]
    context = context[order]
    for shard, part in dealt(at[order], shards):
        heads = np.flatnonzero(_new(context[part])) if len(grams) > 1 else np.zeros(0, np.int64)
        ends = np.append(heads[1:], part.stop - part.start)
        named = b"".join(_six(g[part][heads]) for g in grams[:-1])
        lengths = _small(ends - heads) if len(heads) else None
        yield _rows([(shard, _GRAMS, named, lengths, _six(grams[-1][part]), _small(counts[part]))])


def _places(grams: list[np.ndarray], hot: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the contexts of n-grams, and the shards of the n-grams."""
    context = keys_of(grams[:-1])
    by = np.where(spread(grams[:-1], hot), pair_keys(context, grams[-1]), context)
    return context, key_shards(by, shards)


def _grams_read(rows: list[dict], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams of rows, by place, and their counts."""
    columns: list[list[np.ndarray]] = [[] for _ in range(order)]
    for row in rows:
        if order > 1:
            lengths = _wide(row["b"])
            for column, named in zip(columns, _from_six(row["a"]).reshape(order - 1, -1)):
                column.append(np.repeat(named, lengths))
        columns[-1].append(_from_six(row["c"]))
    return [np.concatenate(c) for c in columns], np.concatenate([_wide(r["d"]) for r in rows])


def _counting(shards: int, hot: np.ndarray, size: int, order: int):
    """Blocks of training text to rows for the shards of n-grams and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, size):
            block = Block(table["text"].to_pylist())
            words, counts = np.unique(block.words, return_counts=True)
            yield _rows(_words_dealt(words, counts, shards))
            grams = block.grams(order)
            keys, at, number = _distinct(keys_of(grams))
            counts = np.bincount(number, minlength=len(keys))
            yield from _grams_dealt([g[at] for g in grams], counts, hot, shards)

    return run


def _summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(_new(keys))
    return [keys[starts], *(np.add.reduceat(c[order], starts) if len(c) else c for c in counts)]


def _by_count(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(f"u{next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))}")


_FOLLOW = ["follow1", "follow2", "follow3", "follow"]


def _followed(context: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Distinct contexts, how many n-grams with count 1, 2 and more each has, and the sum."""
    which = [(counts == 1), (counts == 2), (counts > 2)]
    return _summed(context, *(w.astype(np.int64) for w in which), counts)


def _write_followed(store: Store, name: str, found: list[np.ndarray]) -> None:
    store.write(name, lead=found[0], **{k: _narrow(c) for k, c in zip(_FOLLOW, found[1:])})


def _by_kind(rows: list[dict]) -> list[list[dict]]:
    parts: list[list[dict]] = [[] for _ in range(4)]
    for row in rows:
        parts[row["kind"]].append(row)
    return parts


def _words_read(rows: list[dict]) -> list[np.ndarray]:
    keys = [np.zeros(0, np.uint64)] + [np.frombuffer(r["a"], np.uint64) for r in rows]
    counts = [np.zeros(0, np.int64)] + [_wide(r["b"]) for r in rows]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _totals(rows: list[dict], order: int) -> np.ndarray:
    """Numbers of counts 1 to 4 for each order from 2 on, one row each."""
    none = np.zeros((order - 1, 4), np.int64)
    return sum((np.frombuffer(r["a"], "<i8").reshape(-1, 4) for r in rows), none)


def _spread_written(store: Store, shard: int, level: int, rows: list[dict]) -> None:
    """What follows the contexts of an order whose n-grams are in several shards."""
    if rows:
        keys = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in rows])
        counts = np.concatenate([np.frombuffer(r["b"], "<i8").reshape(4, -1) for r in rows], axis=1)
        _write_followed(store, f"spread{level}-{shard}", _summed(keys, *counts))


def _level_written(store: Store, shards: int, hot: np.ndarray, level: int, order: int):
    """The n-grams of one order added up and written, and the rows for the order below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            words, grams, after, totals = _by_kind(rows)
            _spread_written(store, shard, level + 1, after)
            found = _totals(totals, order)
            if words:
                keys, counts = _words_read(words)
                yield _rows([(shard, _WORDS, keys.tobytes(), _small(counts), None, None)])
            if grams:
                parts, counts = _grams_read(grams, level)
                keys, at, number = _distinct(keys_of(parts))
                counts = _added(number, counts, len(keys))
                parts = [p[at] for p in parts]
                store.write(f"grams{level}-{shard}", keys=keys, counts=_narrow(counts))
                found[level - 2] += _by_count(counts)
                yield from _after_dealt(store, shard, level, parts, counts, hot, shards)
                shorter = parts[1:]
                _, at, number = _distinct(keys_of(shorter))
                kinds = np.bincount(number, minlength=len(at))
                yield from _grams_dealt([p[at] for p in shorter], kinds, hot, shards)
            yield _rows([(shard, _TOTALS, found.astype("<i8").tobytes(), None, None, None)])

    return run


def _added(number: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Sums of counts by number, exact at any size."""
    out = np.zeros(n, np.int64)
    np.add.at(out, number, counts)
    return out


def _after_dealt(store, shard: int, level: int, parts, counts, hot: np.ndarray, shards: int):
    """Writes what follows contexts that are in this shard alone; rows for the spread ones."""
    context, apart = keys_of(parts[:-1]), spread(parts[:-1], hot)
    _write_followed(store, f"grams{level}-{shard}", _followed(context[~apart], counts[~apart]))
    keys, *follow = _followed(context[apart], counts[apart])
    at = key_shards(keys, shards)
    order = np.argsort(at, kind="stable")
    keys, follow = keys[order], np.array(follow, np.int64).reshape(4, -1)[:, order]
    for to, part in dealt(at[order], shards):
        packed = follow[:, part].astype("<i8").tobytes()
        yield _rows([(to, _AFTER, keys[part].tobytes(), packed, None, None)])


_STATS = "words long, tokens long, kinds long, grams array<long>, preceded array<long>"


def _words_written(store: Store, order: int):
    """Word arrays per shard; numbers of words, tokens, kinds of pairs, and of counts 1 to 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            words, grams, after, totals = _by_kind(rows)
            _spread_written(store, shard, 2, after)
            keys, counts = _words_read(words)
            second, preceded = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if grams:
                (second,), preceded = _grams_read(grams, 1)
                second, preceded = _summed(second, preceded)
            store.write(
                f"words-{shard}",
                word=keys, count=_narrow(counts), second=second, preceded=_narrow(preceded),
            )
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "words": len(keys),
                        "tokens": int(counts.sum()),
                        "kinds": int(preceded.sum()),
                        "grams": _totals(totals, order).reshape(-1).tolist(),
                        "preceded": [*_by_count(preceded).tolist(), len(preceded)],
                    }
                ],
                schema=pa.schema(
                    [("words", pa.int64()), ("tokens", pa.int64()), ("kinds", pa.int64()),
                     ("grams", pa.list_(pa.int64())), ("preceded", pa.list_(pa.int64()))]
                ),
            )

    return run


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = map(float, n[:4])
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *(min(max(d, 0.0), i + 1.0) for i, d in enumerate(found))])


class Model:
    """Where the arrays are, and the totals."""

    def __init__(self, store: Store, shards: int, hot: np.ndarray, order: int, totals: dict):
        self.store, self.shards, self.hot, self.order = store, shards, hot, order
        self.words, self.tokens, self.kinds = totals["words"], totals["tokens"], totals["kinds"]
        by_order = np.array(totals["grams"], np.int64).reshape(-1, 4)
        self.discounts = {k + 2: discounts(list(n)) for k, n in enumerate(by_order)}
        self.word_discount = discounts(totals["preceded"])
        ones, twos, *_, all_ = totals["preceded"]
        d = self.word_discount
        left = d[1] * ones + d[2] * twos + d[3] * (all_ - ones - twos)
        self.word_rest = left / self.kinds if self.kinds else 1.0

    def word_probability(self, preceded: np.ndarray) -> np.ndarray:
        """p(w) of words by the number of their distinct predecessors."""
        uniform = self.word_rest / (self.words + 1)
        if not self.kinds:
            return np.full(len(preceded), uniform)
        cut = preceded - self.word_discount[np.minimum(preceded, 3)]
        return np.maximum(cut, 0) / self.kinds + uniform


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in sorted keys, and which of them are there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    there = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
    return at, there


def _lookup(read, name: str, key: str, columns: list[str], wanted: np.ndarray) -> list[np.ndarray]:
    """Values of the wanted keys in one shard, 0 where missing."""
    try:
        keys = read(key, name)
    except FileNotFoundError:
        return [np.zeros(len(wanted), np.int64) for _ in columns]
    at, there = _found(keys, wanted)
    out = []
    for column in columns:
        values = np.zeros(len(wanted), np.int64)
        values[there] = read(column, name)[at[there]]
        out.append(values)
    return out


def _in_shards(shards: np.ndarray, n: int, width: int, ask) -> list[np.ndarray]:
    """Ask shard by shard, in the order of the keys; answers in the order of the questions."""
    order = np.argsort(shards, kind="stable")
    out = [np.zeros(len(shards), np.int64) for _ in range(width)]
    for shard, part in dealt(shards[order], n):
        for column, values in zip(out, ask(shard, order[part])):
            column[order[part]] = values
    return out


def _counts_of(model: Model, read, grams: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """For n-grams with their place in a block: count, and n1, n2, n3, sum of what follows the context."""
    n, level = model.shards, len(grams)
    context, shard = _places(grams, model.hot, n)
    keys, at, number = _distinct(pair_keys(context, grams[-1]))
    (counts,) = _in_shards(
        shard[at], n, 1,
        lambda s, i: _lookup(read, f"grams{level}-{s}", "keys", ["counts"], keys[i]),
    )
    leads, at, lead_of = _distinct(context)
    apart = spread([g[at] for g in grams[:-1]], model.hot)
    follow = np.zeros((4, len(leads)), np.int64)
    for name, part in (("spread", apart), ("grams", ~apart)):
        asked = leads[part]
        follow[:, part] = _in_shards(
            key_shards(asked, n), n, 4,
            lambda s, i: _lookup(read, f"{name}{level}-{s}", "lead", _FOLLOW, asked[i]),
        )
    return counts[number], follow, lead_of


def score_block(model: Model, read, block: Block) -> tuple[np.ndarray, ...]:
    """Per document: tokens, known tokens, base score, model score."""
    n = model.shards
    words, at, word_of = _distinct(block.words)
    (counts,) = _in_shards(
        word_shards(words, n), n, 1,
        lambda s, i: _lookup(read, f"words-{s}", "word", ["count"], words[i]),
    )
    base = np.log10((counts + ADD) / (model.tokens + ADD * (model.words + 1)))
    lower = block.short[at]
    (preceded,) = _in_shards(
        word_shards(words, n), n, 1,
        lambda s, i: _lookup(read, f"words-{s}", "second", ["preceded"], lower[i]),
    )
    p = model.word_probability(preceded)[word_of]
    grams = block.grams(model.order)
    for level in range(2, model.order + 1):
        found, follow, lead_of = _counts_of(model, read, grams[-level:])
        d = model.discounts[level]
        n1, n2, n3, total = follow
        seen = np.maximum(total, 1)
        rest = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / seen, 1.0)
        p *= rest[lead_of]
        p += np.maximum(found - d[np.minimum(found, 3)], 0) / seen[lead_of]
    return (
        block.lengths,
        np.add.reduceat((counts > 0)[word_of].astype(np.int64), block.starts),
        np.add.reduceat(base[word_of], block.starts),
        np.add.reduceat(np.log10(p), block.starts),
    )


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _scoring(model: Model, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.store.reader()
        try:
            for table in blocks(batches, size):
                block = Block(table["text"].to_pylist())
                tokens, known, base, score = score_block(model, read, block)
                out = pa.table(
                    [table["doc_id"], table["held_out"], pa.array(tokens), pa.array(known),
                     pa.array(np.full(len(tokens), model.tokens)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"],
                )
                yield from out.combine_chunks().to_batches()
        finally:
            read.close()

    return run


def frequent_words(texts: DataFrame, shards: int) -> np.ndarray:
    """48-bit hashes of words that may fill more than an eighth of a shard, from 1 % of texts.

    This only spreads the work: the counts do not depend on which words are listed.
    """
    words = F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")
    counted = texts.sample(0.01, seed=1).select(words).groupBy("word").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    rows = counted.filter(F.col("n") > max(total / (8 * shards), 20)).collect()  # 8 per shard at most
    listed = sorted(row["word"].encode("utf-8", "replace") for row in rows)
    edges = np.array([_START >> _SHORT, _END >> _SHORT])
    return np.concatenate([word_hashes(listed) >> _SHORT, edges])


def train(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, order: int = ORDER) -> Model:
    """Count the texts of all rows of ``docs`` and write the model's arrays."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    texts = id_and_text(docs).select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(size) // shard))
    hot = frequent_words(texts, shards)
    store = Store(scratch(spark, "language-model"))

    def in_shards(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard")

    rows, between = texts.mapInArrow(_counting(shards, hot, block, order), _PARTS), []
    for level in range(order, 1, -1):
        written = scratch(spark, f"shorter-than-{level}")
        rows = in_shards(rows).mapInArrow(_level_written(store, shards, hot, level, order), _PARTS)
        rows.write.parquet(written)
        rows = spark.read.schema(_PARTS).parquet(written)
        delete(spark, between)  # what this one was made from
        between = [written]
    stats = in_shards(rows).mapInArrow(_words_written(store, order), _STATS)
    sizes = {"grams": 4 * (order - 1), "preceded": 5}
    total = stats.agg(
        *(F.sum(c).alias(c) for c in ("words", "tokens", "kinds")),
        *(F.array(*(F.sum(F.col(c)[i]) for i in range(n))).alias(c) for c, n in sizes.items()),
    ).first()
    delete(spark, between)
    totals = {k: v or 0 for k, v in total.asDict().items() if not isinstance(v, list)}
    for k in sizes:
        totals[k] = [v or 0 for v in total[k]]
    return Model(store, shards, hot, order, totals)


def score(docs: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """One row per document: tokens, known ones, base score and model score (log10)."""
    rows = id_and_text(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_scoring(model, block), _SCORED)


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    training = docs.filter(~held_out(F.col("doc_id").cast("long")))
    return score(docs, train(training))
