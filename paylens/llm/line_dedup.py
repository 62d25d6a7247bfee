"""Line deduplication over all documents, by hash order.

Each line long enough to count becomes a row (128-bit hash of its key, document, position).
The rows are range-partitioned and sorted by hash, then document, then position, so a task sees
the documents of a key in order and streams past them: the first document keeps its lines, those
of all later ones are dropped. Document and position are part of the range key, so the rows of a
very common line are spread over several tasks. Each task says which key it began with, which it
ended with, and the first document it saw for that; these two rows per task, whatever the number of
documents, tell for each range the first document of its first key. The rows of a first key look
there by the number of their range, so those of a very common line stay spread.

What comes back per document is a compressed bitmap of the lines to keep, not text.

Defined cases: a null or empty text is one empty line, which is always kept; documents without
doc_id come last and count as one document; rows that repeat a doc_id count as one document for
the question which lines are shared, and lose lines each for itself; a very long text is held whole by the task that
splits it, and by the one that applies its bitmap. Two keys are taken as equal
when their 128-bit BLAKE2 hashes are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import id_and_text, order_key, partitions_for, read_table, saved

LEAST = 10  # code points of a key
_SPACE = b" \t\n\v\f\r"
_ROW_BYTES = 36
_TARGET = 16 * 2**20

_LINES = "hi long, lo long, d long, t long, pos int"
_FOUND = "hi long, lo long, d long, t long, pos int, kind int, first long, part int"
_FOUND_COLUMNS = ["hi", "lo", "d", "t", "pos", "kind", "first", "part"]
_DROPPED, _TAIL, _HEAD, _RANGE = 0, 1, 2, 3


def line_keys(text: str, least: int) -> tuple[list[int], list[bytes]]:
    """Positions and hashes of the lines of a text whose keys are long enough."""
    at, hashes = [], []
    for i, line in enumerate(text.encode("utf-8", "replace").split(b"\n")):
        key = line.strip(_SPACE)
        if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
            at.append(i)
            hashes.append(hashlib.blake2b(key.lower(), digest_size=16).digest())
    return at, hashes


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ds, ts = batch["d"].to_numpy(), batch["t"].to_numpy()
            for start in range(0, batch.num_rows, 512):
                counts, at, hashes = [], [], []
                for text in batch["text"].slice(start, 512).to_pylist():
                    a, h = line_keys(text, least)
                    counts.append(len(a))
                    at += a
                    hashes += h
                both = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(both[:, 0]),
                        pa.array(both[:, 1]),
                        pa.array(np.repeat(ds[start : start + 512], counts)),
                        pa.array(np.repeat(ts[start : start + 512], counts)),
                        pa.array(np.array(at, np.int32)),
                    ],
                    ["hi", "lo", "d", "t", "pos"],
                )

    return run


def _edge(key: tuple[int, int], kind: int, first: int | None, part: int) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.int32()]
    cells = [*key, None, None, None, kind, first, part]
    return pa.RecordBatch.from_arrays(
        [pa.array([c], t) for c, t in zip(cells, types)], _FOUND_COLUMNS
    )


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, sorted: the dropped ones, all of the first key, the first and last key."""
    part = TaskContext.get().partitionId()
    key, first, head = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, d = (batch[c].to_numpy() for c in ("hi", "lo", "d"))
        new = np.empty(len(hi), bool)
        new[0] = key != (hi[0], lo[0])
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1  # -1: goes on with the key of the batch before
        firsts = np.where(run < 0, first, d[starts][run] if len(starts) else first)
        if key is None:
            in_head = run == 0
            yield _edge((hi[0], lo[0]), _RANGE, None, part)
        else:
            in_head = (run < 0) & head
        keep = in_head | (d > firsts)
        kind = np.where(in_head, _HEAD, _DROPPED).astype(np.int32)[keep]
        out = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(kind), pa.array(firsts[keep]),
             pa.array(np.full(len(kind), part, np.int32))],
            _FOUND_COLUMNS,
        )
        head = bool(in_head[-1])
        key, first = (hi[-1], lo[-1]), int(firsts[-1])
    if key is not None:
        yield _edge(key, _TAIL, first, part)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for dropped in batch["dropped"]:
            at = dropped.values.to_numpy()
            keep = np.ones((int(at.max()) // 8 + 1) * 8, np.uint8)
            keep[at] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch["d"], batch["t"], pa.array(maps, pa.binary())], ["d", "t", "bitmap"]
        )


def read_bitmap(bitmap: bytes | None, n: int) -> np.ndarray:
    """Which of n lines stay; lines beyond the bitmap's end do."""
    keep = np.ones(n, bool)
    if bitmap:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)
        keep[: len(bits)] = bits[:n]
        keep[len(bits) :] = True
    return keep


def _keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).select(
        "doc_id", order_key(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("t"), "text"
    )


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """d, t, bitmap for each document that loses lines.

    d: the document's order key, t: hash of its text (tells rows with the same doc_id apart);
    bitmap: zlib of bits, one for each line from the first, 1: stays; lines beyond its end stay.
    """
    spark = docs.sparkSession
    lines = saved(_keyed(docs).select("d", "t", "text").mapInArrow(_lines(least), _LINES), "lines")
    n = partitions_for(spark, lines.count() * _ROW_BYTES, _TARGET)
    by = ["hi", "lo", "d", "pos"]
    found = saved(
        lines.repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .mapInArrow(_first_occurrences, _FOUND),
        "line-first",
    )
    tails = (
        found.filter(F.col("kind") == _TAIL)
        .groupBy("hi", "lo")
        .agg(F.min("first").alias("earlier"))
    )
    ranges = found.filter(F.col("kind") == _RANGE).select("hi", "lo", "part")
    heads = (
        found.filter(F.col("kind") == _HEAD)
        .join(ranges.join(tails, ["hi", "lo"]).select("part", "earlier"), "part", "left")
        .filter(F.col("d") > F.least("first", "earlier"))
    )
    dropped = found.filter(F.col("kind") == _DROPPED).select("d", "t", "pos")
    dropped = dropped.unionByName(heads.select("d", "t", "pos"))
    return (
        dropped.groupBy("d", "t")
        .agg(F.collect_list("pos").alias("dropped"))
        .mapInArrow(_bitmaps, "d long, t long, bitmap binary")
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, shas = [], [], []
        for text, bitmap in zip(batch["text"].to_pylist(), batch["bitmap"].to_pylist()):
            n = text.count("\n") + 1
            if bitmap:
                keep = read_bitmap(bitmap, n)
                text = "\n".join(x for x, k in zip(text.split("\n"), keep) if k)
                n_dropped.append(n - int(keep.sum()))
            else:
                n_dropped.append(0)
            n_lines.append(n)
            shas.append(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n_lines), pa.array(n_dropped), pa.array(shas)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    maps = saved(keep_bitmaps(docs), "line-bitmaps")
    return (
        _keyed(docs)
        .join(maps, ["d", "t"], "left")
        .select("doc_id", "text", "bitmap")
        .mapInArrow(_apply, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
    )


ORACLE = r"""
WITH docs AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM numbered
), firsts AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY 1
), judged AS (
    SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS dropped
    FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
           AS kept_sha256
FROM judged GROUP BY doc_id
"""
