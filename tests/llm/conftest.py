from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHING = (
    "d t c n s e at text_hash kept keep_id digest score label size target copies copy path comp "
    "low hash words stood window shard kind anchor context hi lo pos bitmap rows"
).split()


@pytest.fixture(scope="session")
def table(spark):
    """documents from (doc_id, text) or (doc_id, text, source) rows."""

    def build(rows, partitions=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def with_clashes():
    """The same documents with further columns named like those used inside."""
    return lambda df: df.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def corpus():
    """Random texts with copies, near copies, shared passages, odd cells and repeated rows."""

    def build(seed, n=60, words=40):
        rng = random.Random(seed)
        vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
        passage = " ".join(rng.choice(vocabulary) for _ in range(30))

        def fresh():
            lines = [
                " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, words // 2)))
                for _ in range(rng.randrange(1, 6))
            ]
            return "\n".join(lines)

        rows = []
        for i in range(n):
            kind = rng.random()
            if rows and kind < 0.15:
                text = rng.choice(rows)[1]
            elif rows and kind < 0.45:
                text = (rng.choice(rows)[1] or "").split(" ")
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
                text = " ".join(text)
            elif kind < 0.65:
                text = f"{fresh()}\n{passage}\n{fresh()}"
            elif kind < 0.70:
                text = "The " * rng.randrange(60)
            else:
                text = fresh()
            rows.append((i * 3, text))
        rows += [(1, None), (2, ""), (4, None), (5, " \t\n"), (None, rows[0][1]), (None, "a b")]
        rows += [rows[3], rows[3], (rows[4][0], "another text of the same id " * 6)]
        rows.append((999, " ".join(rng.choice(vocabulary) for _ in range(6000))))
        rng.shuffle(rows)
        return rows

    return build
