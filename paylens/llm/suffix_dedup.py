"""Removal of long repeated byte strings by suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts earlier, in a document
with a smaller id or further up in the same one.

1. Every string of that length holds an anchor, the least of the hashes of its ``GRAM``-byte parts.
   Equal strings have the same anchor, so only anchors that occur twice can lie in a repeat. Blocks of
   text send the sorted hashes of their anchors to shards and get back one bit for each.
2. Around each repeated anchor a context is cut, just wide enough for the strings that have this
   anchor. Equal contexts of a block are combined at once: all but the first are repeats.
3. Contexts with the same anchor meet in one task, which sorts all their suffixes in two stages:
   suffixes smaller than their successor are sorted directly; one scan over the buckets of first bytes puts the others in place, each taking its order from its
   successor. Common prefixes of neighbours in this order show the strings that are equal, and
   all but the first of each are repeats.
4. The repeats of a document are merged and cut out.

An anchor with very many different contexts (the edge of a passage that many documents share) is not
given to one task: its strings are grouped by themselves.

Defined cases: a null or empty text, and any shorter than ``length``, loses nothing; documents without doc_id come last; rows with the same doc_id are ordered by
a hash of their text; rows that repeat doc_id and text are one document, and each gets its result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import blocks, by_shard, dealt
from paylens.llm.common import id_and_text, order_key, read_table, saved, scratch
from paylens.llm.store import Store

LENGTH = 100
GRAM = 16
BLOCK = 24 * 2**20  # bytes of text that a task works on at once
SHARD = 64 * 2**20  # bytes of text per shard of anchors
SORTED = 2**20  # bytes of contexts in one suffix array
CROWD = 20_000  # contexts of an anchor that go into one suffix array
_CHUNK = 2**18
_PRIME = 0x9E3779B97F4A7C15


def _windowed(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every ``gram`` bytes (a multiple of 8)."""
    h, size, prime = data.astype(np.uint64) + np.uint64(1), 1, _PRIME
    while size < 8:
        h = h[:-size] * np.uint64(prime) + h[size:]
        prime, size = prime * prime % 2**64, 2 * size
    eight = h
    while size < gram:
        h = h[: len(eight) - size] * np.uint64(prime) + eight[size:]
        size += 8
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Every anchor: number of its text, its hash, and the range of the strings that have it.

    The range goes from the first byte of the first such string to the last byte of the last;
    strings that start next to each other mostly have the same anchor. Ranges come in order.
    """
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]]
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= _CHUNK):
            size += len(texts[end])
            end += 1
        data = np.frombuffer(b"".join(texts[start:end]), np.uint8)
        if len(data) >= length:
            sizes = np.array([len(t) for t in texts[start:end]])
            ends = np.cumsum(sizes)
            own = gram_hashes(data, gram)
            bits = np.uint64(int(len(data)).bit_length())
            packed = (own >> bits << bits) | np.arange(len(own), dtype=np.uint64)
            least = _windowed(packed, length - gram + 1)
            text_of = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
            inside = np.flatnonzero(np.arange(len(least)) + length <= ends[text_of])
            anchor = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            first = np.flatnonzero(np.diff(anchor, prepend=-1))
            last = np.append(first[1:], len(anchor))[: len(first)] - 1
            number = text_of[inside[first]]
            before = (ends - sizes)[number]
            found.append(
                [number + start, inside[first] - before, inside[last] - before + length,
                 own[anchor[first]]]
            )
        start = end
    which, s, e, hashes = (np.concatenate(x) for x in zip(*found))
    return which, s, e, hashes


def _block_name(table: pa.Table) -> str:
    keys = np.concatenate([table["d"].to_numpy(), table["t"].to_numpy()])
    return hashlib.blake2b(keys.tobytes(), digest_size=16).hexdigest()


def _bytes_of(table: pa.Table) -> list[bytes]:
    return table["text"].cast(pa.binary()).to_pylist()


def _shards_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)


_SENT = "shard long, block string, hashes binary, twice binary"


def _send_anchors(shards: int, block: int, length: int):
    """Per block and shard: sorted distinct anchor hashes, and which the block has twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, block):
            hashes, counts = np.unique(anchors(_bytes_of(table), length)[3], return_counts=True)
            at = _shards_of(hashes, shards)
            order = np.argsort(at, kind="stable")
            hashes, twice, at = hashes[order], (counts > 1)[order], at[order]
            rows = [
                (shard, hashes[part].tobytes(), np.packbits(twice[part]).tobytes())
                for shard, part in dealt(at, shards)
            ]
            name = _block_name(table)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([name] * len(rows)),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                ["shard", "block", "hashes", "twice"],
            )

    return run


def _find_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and shard: the hashes that occur twice anywhere."""
    for shard, rows in by_shard(batches):
        own = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        twice = [
            np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(h)).astype(bool)
            for r, h in zip(rows, own)
        ]
        hashes, counts = np.unique(np.concatenate(own), return_counts=True)
        repeated = counts > 1
        for h, t in zip(own, twice):
            repeated[np.searchsorted(hashes, h[t])] = True
        found = [h[repeated[np.searchsorted(hashes, h)]].tobytes() for h in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["block"] for r in rows]), pa.array(found, pa.binary())],
            ["block", "hashes"],
        )


def _store_repeated(store: Store):
    """One sorted array of repeated hashes per block, from rows (block, hashes list)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store.write(row["block"], repeated=np.sort(np.frombuffer(b"".join(row["parts"]), np.uint64)))
            yield pa.RecordBatch.from_arrays([batch["block"]], ["block"])

    return run


_CUT = "kind int, anchor long, context binary, d long, t long, s long, e long"
_REPEAT, _CONTEXT = 0, 1


def _cut_contexts(store: Store, block: int, length: int):
    """Contexts of repeated anchors; equal ones of a block once, the others as repeats at once.

    If the rows come in other blocks than before, every anchor counts as repeated: more to sort, the
    same result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = store.reader()
        for table in blocks(batches, block):
            texts = _bytes_of(table)
            which, s, e, hashes = anchors(texts, length)
            try:
                repeated = read("repeated", _block_name(table))
                place = np.minimum(np.searchsorted(repeated, hashes), max(len(repeated) - 1, 0))
                keep = repeated[place] == hashes if len(repeated) else np.zeros(len(hashes), bool)
            except FileNotFoundError:
                keep = np.ones(len(hashes), bool)
            d, t = table["d"].to_numpy(), table["t"].to_numpy()
            order = np.flatnonzero(keep)
            order = order[np.lexsort((s[order], t[which[order]], d[which[order]]))]
            found = (x[order].tolist() for x in (which, s, e, hashes.view(np.int64)))
            yield from _distinct_contexts(texts, d.tolist(), t.tolist(), *found)
        read.close()

    return run


def _distinct_contexts(texts, d, t, which, starts, ends, hashes) -> Iterator[pa.RecordBatch]:
    """Contexts in the order of their places: the first of equal ones, and repeats for the rest."""
    seen: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    repeats: list[list[int]] = []
    for i, s, e, anchor in zip(which, starts, ends, hashes):
        place = (d[i], t[i], s)
        if seen.setdefault((anchor, texts[i][s:e]), place) != place:
            last = repeats[-1] if repeats else (None, None, 0, 0)
            if last[0] == d[i] and last[1] == t[i] and s <= last[3]:
                last[3] = max(e, last[3])
            else:
                repeats.append([d[i], t[i], s, e])
    keys = list(seen)
    places = list(seen.values())
    for start in range(0, len(keys), 20_000):
        part, own = keys[start : start + 20_000], places[start : start + 20_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_CONTEXT] * len(part), pa.int32()),
                pa.array([k[0] for k in part], pa.int64()),
                pa.array([k[1] for k in part], pa.binary()),
                *(pa.array([p[j] for p in own], pa.int64()) for j in range(3)),
                pa.array([p[2] + len(k[1]) for k, p in zip(part, own)], pa.int64()),
            ],
            ["kind", "anchor", "context", "d", "t", "s", "e"],
        )
    n = len(repeats)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([_REPEAT] * n, pa.int32()),
            pa.array([None] * n, pa.int64()),
            pa.array([None] * n, pa.binary()),
            *(pa.array([r[j] for r in repeats], pa.int64()) for j in range(4)),
        ],
        ["kind", "anchor", "context", "d", "t", "s", "e"],
    )


# The suffix array.


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number; zeros follow the end."""
    w = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        w = (w[:-shift] << np.uint64(8 * shift)) | w[shift:]
    return w[: len(text)]


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor; a run of one byte is as its end."""
    step = np.diff(text.astype(np.int16), append=-1)
    place = np.where(step != 0, np.arange(len(text)), len(text))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return step[np.minimum(following, len(text) - 1)] > 0


def _sort_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """These suffixes in order of their first ``depth`` bytes."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[at]
    return at[np.argsort(rows.view(f"S{depth}")[:, 0], kind="stable")]


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes of text in the order of their first ``depth`` bytes.

    text: byte values plus one; zeros end the strings it consists of. What follows a zero
    does not count, so the order of suffixes that are equal up to their zero is arbitrary. wanted:
    a mask; with a suffix it must hold the one before it in the same string.
    """
    direct = _smaller_than_next(text)
    direct[text == 0] = True
    # A suffix that is not sorted directly needs its successor, up to the next direct one.
    n = len(text)
    following = np.where(direct, np.arange(n), n - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, last, 1)
    np.add.at(edges, following[last] + 1, -1)
    needed = wanted | (np.cumsum(edges[:n]) > 0)

    letters = text[needed]
    counts = np.bincount(letters, minlength=256)
    starts = np.cumsum(counts) - counts
    order = np.full(len(letters), -1, np.int64)
    by_depth = _sort_directly(text, np.flatnonzero(direct & needed), depth)
    own = np.bincount(text[by_depth], minlength=256)
    begins = starts + counts - own  # directly sorted suffixes end their bucket
    done = 0
    for byte in np.flatnonzero(own):
        order[begins[byte] : begins[byte] + own[byte]] = by_depth[done : done + own[byte]]
        done += own[byte]
    heads = starts.copy()
    for byte in np.flatnonzero(counts):
        layer = order[starts[byte] : heads[byte]]  # induced from smaller buckets
        while len(layer):  # their predecessors in runs of this byte follow them
            before = layer[layer > 0] - 1
            layer = before[(text[before] == byte) & ~direct[before]]
            order[heads[byte] : heads[byte] + len(layer)] = layer
            heads[byte] += len(layer)
        bucket = order[starts[byte] : starts[byte] + counts[byte]]
        before = bucket[bucket > 0] - 1
        before = before[text[before] > byte]
        first = text[before]
        sorted_ = np.argsort(first, kind="stable")
        before, first = before[sorted_], first[sorted_]
        added = np.bincount(first, minlength=256)
        rank = np.arange(len(before)) - np.repeat(np.cumsum(added) - added, added)
        order[heads[first] + rank] = before
        heads += added
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, rest: np.ndarray, depth: int):
    """Common prefix of each suffix with the one before it in order, up to ``depth``."""
    words, n = _words(text), len(text)
    shared = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for offset in range(0, depth, 8):
        a, b = order[alive] + offset, order[alive - 1] + offset
        inside = (a < n) & (b < n)
        alive, a, b = alive[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        for byte in range(7):
            shared[alive] += (differ >> np.uint64(8 * (7 - byte))) == 0
        shared[alive] += same
        alive = alive[same]
    limit = np.minimum(rest[order], np.append(0, rest[order[:-1]]))
    return np.minimum(shared, np.minimum(limit, depth))


def repeated_strings(contexts: list[bytes], places: np.ndarray, length: int) -> np.ndarray:
    """Repeats among distinct contexts: rows of (context, from, to), in bytes of the context.

    places: d, t and start of each context. A string counts as repeated where an equal one starts at
    a smaller place.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int16) + 1
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text[starts + sizes] = 0
    text = text.astype(np.uint8)
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    offset = np.arange(len(text)) - starts[owner]
    rest = sizes[owner] - offset
    order = suffix_array(text, rest >= length, length)
    if not len(order):
        return np.zeros((0, 3), np.int64)
    equal = common_prefixes(text, order, rest, length) >= length
    _, document = np.unique(places[:, :2], axis=0, return_inverse=True)
    place = (document.reshape(-1)[owner[order]].astype(np.int64) << 40) + (
        places[owner[order], 2] + offset[order]
    )
    run_starts = np.flatnonzero(~equal)
    first = np.minimum.reduceat(place, run_starts)
    run = np.cumsum(~equal) - 1
    at = np.sort(order[place > first[run]])
    if not len(at):
        return np.zeros((0, 3), np.int64)
    new = np.append(True, (np.diff(at) > 1) | (np.diff(owner[at]) > 0))
    begin = at[new]
    end = at[np.append(new[1:], True)] + length
    return np.stack([owner[begin], offset[begin], end - starts[owner[begin]]], axis=1)


_SPAN = "d long, t long, s long, e long"


def _spans_batch(d, t, s, e) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x, np.int64)) for x in (d, t, s, e)], ["d", "t", "s", "e"]
    )


def _sort_contexts(length: int, size: int):
    """Suffix arrays over contexts that come sorted by anchor; an anchor is never divided."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        distinct: dict[bytes, tuple[int, int, int]] = {}
        same = []
        for _, context, *place in rows:
            place = tuple(place)
            known = distinct.get(context)
            if known is None:
                distinct[context] = place
            elif place != known:
                first, later = min(place, known), max(place, known)
                distinct[context] = first
                same.append((*later, later[2] + len(context)))
        if same:
            yield _spans_batch(*zip(*same))
        contexts = list(distinct)
        places = np.array(list(distinct.values()), np.int64).reshape(-1, 3)
        found = repeated_strings(contexts, places, length)
        own = places[found[:, 0]]
        yield _spans_batch(own[:, 0], own[:, 1], own[:, 2] + found[:, 1], own[:, 2] + found[:, 2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, last = [], 0, None
        for batch in batches:
            cols = [batch[c].to_pylist() for c in ("anchor", "context", "d", "t", "s")]
            for row in zip(*cols):
                if total >= size and row[0] != last:
                    yield from solve(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[1]) + 1
                last = row[0]
        if held:
            yield from solve(held)

    return run


def _crowded_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Repeats around anchors with very many contexts: their strings, each grouped by itself.

    Only the MD5 of a string is moved.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("e") - F.col("s") - length)
    strings = contexts.select("d", "t", "s", "context", F.explode(starts).alias("at")).select(
        "d",
        "t",
        (F.col("s") + F.col("at")).alias("s"),
        F.unhex(
            F.md5(F.substring("context", (F.col("at") + 1).cast("int"), F.lit(length)))
        ).alias("string"),
    )
    firsts = strings.groupBy("string").agg(
        F.min(F.struct("d", "t", "s")).alias("first"), F.count("*").alias("n")
    )
    firsts = saved(firsts.filter("n > 1").select("string", "first"), "crowded-firsts")
    later = strings.join(firsts, "string").filter(F.struct("d", "t", "s") != F.col("first"))
    return later.select("d", "t", "s", (F.col("s") + length).alias("e"))


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    block: int = BLOCK,
    shard: int = SHARD,
    size: int = SORTED,
    crowd: int = CROWD,
) -> DataFrame:
    """Repeated byte ranges, not yet merged: d, t, s, e (order key of doc_id, hash of text)."""
    spark = docs.sparkSession
    texts = _keyed(docs).select("d", "t", "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard))
    found = (
        texts.mapInArrow(_send_anchors(shards, block, length), _SENT)
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard")
        .mapInArrow(_find_repeated, "block string, hashes binary")
    )
    store = Store(scratch(spark, "anchors"))
    (
        saved(found, "repeated-anchors")
        .groupBy("block")
        .agg(F.collect_list("hashes").alias("parts"))  # of one block, so bounded
        .mapInArrow(_store_repeated(store), "block string")
        .write.format("noop")
        .mode("overwrite")
        .save()
    )
    cut = saved(texts.mapInArrow(_cut_contexts(store, block, length), _CUT), "contexts")
    contexts = cut.filter(F.col("kind") == _CONTEXT).select("anchor", "context", "d", "t", "s", "e")
    counts = contexts.groupBy("anchor").agg(F.count("*").alias("n"))
    crowded = saved(counts.filter(F.col("n") > crowd).select("anchor"), "crowded")
    spans = cut.filter(F.col("kind") == _REPEAT).select("d", "t", "s", "e")
    if not crowded.isEmpty():
        some = contexts.join(crowded, "anchor", "left_semi")
        spans = spans.unionByName(_crowded_spans(some, length))
        contexts = contexts.join(crowded, "anchor", "left_anti")
    sorted_ = (
        contexts.select("anchor", "context", "d", "t", "s")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sort_contexts(length, size), _SPAN)
    )
    return spans.unionByName(sorted_)


def _keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).select(
        "doc_id", order_key(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("t"), "text"
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges; those that touch are one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for text, spans in zip(texts, batch["spans"].to_pylist()):
            ranges = merged([(x["s"], x["e"]) for x in spans or []])
            kept, at = [], 0
            for s, e in ranges:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            removed = sum(e - s for s, e in ranges)
            digest = hashlib.sha256(b"".join(kept)).hexdigest()
            rows.append((len(text), removed, len(ranges), digest))
        cols = list(zip(*rows)) or [[] for _ in range(4)]
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    spans = saved(repeated_spans(docs), "spans")
    grouped = spans.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return (
        _keyed(docs)
        .join(grouped, ["d", "t"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _remove,
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        )
    )


ORACLE = r"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits,
           octet_length(encode(coalesce(text, ''))) AS n_bytes
    FROM documents
), strings AS (
    SELECT doc_id, i AS start, md5(substr(digits, 2 * i + 1, 200)) AS string
    FROM texts, unnest(range(0, n_bytes - 99)) AS t(i)
), firsts AS (
    SELECT string, min(row(doc_id, start)) AS place FROM strings GROUP BY 1 HAVING count(*) > 1
), later AS (
    SELECT doc_id, start FROM strings JOIN firsts USING (string)
    WHERE row(doc_id, start) <> place
), marked AS (
    SELECT doc_id, start,
           coalesce(start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) > 100, true)
               AS opens
    FROM later
), runs AS (
    SELECT doc_id, start, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY start) AS run
    FROM marked
), spans AS (
    SELECT doc_id, run, min(start) AS s, max(start) + 100 AS e FROM runs GROUP BY ALL
), gaps AS (
    SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before
    FROM spans
), kept AS (
    SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last_end,
           string_agg(substr(digits, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(digits, 2 * last_end + 1), digits))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
