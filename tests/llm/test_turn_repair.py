"""Conversation repair against a search over all edits, and the planted faults against plain code."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from paylens.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def search(initials, faults):
    """Least (cost, audit) by trying every edit, with at most three insertions in a row."""
    n = len(faults)

    @lru_cache(None)
    def go(i, before, inserted):
        found = [(0, "")] if i == n and before in ("", "a") else []

        def add(cost, letter, rest):
            found.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            add(3, "I", go(i, AFTER[before], inserted + 1))
        if i < n:
            add(4, "D", go(i + 1, before, 0))
            if faults[i] not in (1, 2):
                more = 3 if faults[i] == 3 else 0
                if initials[i] == AFTER[before] or (initials[i], before) == ("s", ""):
                    add(more, "K", go(i + 1, initials[i], 0))
                add(more + 3, "R", go(i + 1, AFTER[before], 0))
        return min(found, default=(10**9, ""))

    return go(0, "", 0)


def test_cheapest_against_search():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randrange(9)
        initials = [rng.choice(["s", "u", "a", "u", "a", "t", ""]) for _ in range(n)]
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert R.cheapest(initials, faults) == search(tuple(initials), faults)


def test_prices_are_converged():
    rng = random.Random(2)
    initials = [rng.choice("suua") for _ in range(300)]
    faults = bytes(rng.choice([0, 0, 1, 3]) for _ in range(300))
    price = R.prices(initials, faults)
    for node in range(4 * 301):
        if node >= 1200 and node - 1200 in R.FINAL:
            assert price[node] == 0
            continue
        arcs = list(R._arcs(node, initials, faults))
        assert price[node] == min(cost + price[end] for _, cost, end in arcs)


def test_a_long_conversation_takes_linear_time():
    n = 60_000
    cost, audit = R.cheapest(["a"] * n, bytes(n))
    assert (cost, len(audit.replace("I", ""))) == (3 * n // 2, n)


ROLES = {"u": "user", "a": "assistant"}


def plain(rows, damage):
    """All result columns by plain code."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        said = [" " if x is None else x for x in (conv, turn, role, text)]
        role, text = said[2:]
        mark = hashlib.sha256(text.encode()).hexdigest()
        place = (turn is not None, turn or 0, role, mark)
        kind = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20 if damage else 9
        into = conversations[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        into += [(place, copy, turn, role, text) for copy in range(1 + (kind == 3))]
    out = {}
    for conv, found in conversations.items():
        found.sort(key=lambda r: r[:2])
        seen, faults = set(), []
        for *_, role, text in found:
            ink = text.strip(" \t\n\v\f\r")
            repeated = (role, text) in seen
            faults.append(1 if not ink else 2 if repeated else 3 if ink[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = tuple(r[3][:1] for r in found)
        cost, audit = search(initials, bytes(faults))
        before, i, kept = "", 0, []
        for edit in audit:
            if edit != "D":
                before = initials[i] if edit == "K" else AFTER[before]
                role = found[i][3] if edit == "K" else ROLES[before]
                kept.append(f"{role}:{'' if edit == 'I' else found[i][4]}")
            i += edit != "I"
        turns = {r[2] for r in found} - {None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(kind) for kind in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    texts = ["fine.", "fine.", "no end", " \t", "", None, "Ok! ", "é?\n", "a.b", "why?! so"]
    rows = []
    for conv in [*range(150), None, None]:
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            number = rng.choice([turn, turn, turn * 2, None])
            rows.append((conv, number, role, rng.choice(texts)))
    return rows + rows[:20] + [(3, 50, "user", "very long. " * 30_000)]


@pytest.mark.parametrize("damage", [True, False])
def test_against_plain_code(spark, turns, damage):
    df = spark.createDataFrame(turns, SCHEMA).repartition(3)
    marked = R.damaged(df) if damage else R.given(df)
    got = {r.conv_id: tuple(r)[1:] for r in R.figures(R.repaired(marked)).collect()}
    assert got == plain(turns, damage)


def test_a_conversation_without_rows_after_damage(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)
    (row,) = R.figures(R.repaired(R.damaged(df))).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 1, "user", "B."), (1, 4, "user", "C")]
    found = R.repaired(R.given(spark.createDataFrame(rows, SCHEMA))).collect()
    turns = [(r.position, r.edit, r.role, r.text) for r in found if r.audit is None]
    (figures,) = [r for r in found if r.audit is not None]
    assert turns == [(0, "I", "user", ""), (1, "K", "assistant", "A."), (2, "K", "user", "B."),
                     (3, "R", "assistant", "C")]
    assert (figures.audit, figures.cost, figures.gaps) == ("IKKDR", 13, 2)


def test_empty_table_and_clashing_columns(spark, turns, with_clashes):
    assert R.figures(R.repaired(R.damaged(spark.createDataFrame([], SCHEMA)))).collect() == []
    names = "turn_ role0 mark copy gone said own fault initial kind edit position".split()
    df = with_clashes(spark.createDataFrame(turns, SCHEMA))
    df = df.withColumns({name: R.F.lit("x") for name in names})
    got = {r.conv_id: tuple(r)[1:] for r in R.figures(R.repaired(R.damaged(df))).collect()}
    assert got == plain(turns, True)
