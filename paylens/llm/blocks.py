"""Regrouping rows inside tasks: blocks of text of bounded size, and all rows of one shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows regrouped to about ``size`` bytes of text; a longer text is a block of its own."""
    held, total = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            held.append(part)
            total += int(part["text"].nbytes)
            if total >= size:
                yield pa.Table.from_batches(held)
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def dealt(shards: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """Runs of equal shard in sorted shard numbers."""
    edges = np.searchsorted(shards, np.arange(n + 1))
    for shard in range(n):
        if edges[shard] < edges[shard + 1]:
            yield shard, slice(edges[shard], edges[shard + 1])


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """All rows of one shard after another, from rows sorted by shard."""
    shard, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                if held:
                    yield shard, held
                shard, held = row["shard"], []
            held.append(row)
    if held:
        yield shard, held
