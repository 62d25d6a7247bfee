"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Legal is an optional system turn, then user and assistant in turns, or nothing. Keeping a turn costs 0,
giving it another role 3, deleting it 4 and inserting an empty turn 3; a truncated turn that stays
costs 3 more, and blank or repeated turns have to go. The edits of a conversation are a shortest path
over a lattice of nodes (turns done, role before) with integer costs.

The path is found by the auction algorithm. Nodes have prices, at first 0, with price[i] <= cost(i, j) +
price[j] for every arc. A path grows from an origin: where the best arc of its last node costs more
than the node's price, the price is raised to it and the path gives up that node (contraction);
otherwise the path goes on along that arc (extension). All nodes are origins, the last turns' first, so
that a path can end at the first node whose price has converged. The nodes of a turn start at the least
price of the next turn's, which no arc undercuts; every node is then dealt with in a few steps, and the
whole in time linear in the turns. With all prices converged an arc is
tight, price[i] = cost(i, j) + price[j], exactly where it lies on a cheapest path. The audit follows tight
arcs from the first node and takes the least letter at each; a letter leads to one node only, so this
is the least of all cheapest audits.

How it runs: for each turn, a narrow record with its fault and a record with its text are
shuffled by conversation and sorted, all narrow ones first. A task streams them: it holds a
conversation's faults and prices (about 40 bytes per turn), then writes the repaired turns
while their texts pass. A conversation with very many turns so takes one task longer but no
more memory than its audit, one cell of the result, does anyhow.

Defined results: turns are ordered by turn (nulls first), then role, then a digest of the text;
repeated rows are turns like any others (the later ones are duplicates). Missing roles and texts count
as one space. Rows without conv_id are one conversation with a null id. A role with another
initial than s, u or a is never kept. An empty table gives an empty result. Further columns are
ignored. Very long texts are never cut.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.llm.common import WHITE, read_table, ship

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
# The role before: none, system, user, assistant. A sequence may end after none and assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
NEXT_ROLE = (USER, USER, ASSISTANT, USER)  # the only role that can be inserted or given
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
LEGAL = {"su", "ua", "au"}
CONVERGED = 1 << 62


def _arcs(node: int, initials: str, faults: bytes) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and end of a node's arcs, by letter."""
    turn, state = divmod(node, 4)
    there = turn < len(faults)
    if there:
        yield DELETE, COST[DELETE], node + 4
    yield INSERT, COST[INSERT], 4 * turn + NEXT_ROLE[state]
    if there and faults[turn] not in (BLANK, DUPLICATE):
        more = TRUNCATED_COST if faults[turn] == TRUNCATED else 0
        kept = KEPT.get(initials[turn], (None,) * 4)[state]
        if kept is not None:
            yield KEEP, COST[KEEP] + more, 4 * turn + 4 + kept
        yield REROLE, COST[REROLE] + more, 4 * turn + 4 + NEXT_ROLE[state]


def prices(initials: str, faults: bytes) -> array:
    """Converged prices: each node's least cost to the end, which is turn len(faults) in a final state."""
    n = len(faults)
    price = array("q", bytes(8 * 4 * (n + 1)))
    done = bytearray(4 * (n + 1))
    for state in FINAL:
        done[4 * n + state] = 1
    for turn in range(n, -1, -1):
        if turn < n:  # a lower bound for all four, so that they need not outbid each other up to it
            least = min(price[4 * turn + 4 : 4 * turn + 8])
            price[4 * turn : 4 * turn + 4] = array("q", [least] * 4)
        for origin in range(4 * turn, 4 * turn + 4):
            path = [origin]
            while not done[path[-1]]:
                node = path[-1]
                least, end = CONVERGED, node
                for _, cost, other in _arcs(node, initials, faults):
                    if cost + price[other] < least:
                        least, end = cost + price[other], other
                if price[node] < least:
                    price[node] = least
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(end)
            for node in path:  # tight up to a converged node
                done[node] = 1
    return price


def cheapest(initials: str, faults: bytes) -> tuple[int, str]:
    """Least cost of repairing a conversation and the least of its audits."""
    price = prices(initials, faults)
    node, letters, last = 0, [], 4 * len(faults)
    while node < last or node - last not in FINAL:
        for letter, cost, end in _arcs(node, initials, faults):
            if price[node] == cost + price[end]:
                letters.append(letter)
                node = end
                break
    return price[0], "".join(letters)


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the faults that the test of this operator plants, by a hash of conv_id and turn.

    Turns that are dropped stay as rows marked ``gone``, so that no conversation is forgotten.
    """
    kind = F.crc32(F.concat_ws(":", _spaced(F.col("conv_id")), _spaced(F.col("turn")))) % 20
    text = _spaced(F.col("text"))
    found = _read(turns).withColumn("kind", kind)
    return found.select(
        "conv_id",
        "turn",
        "role0",
        "mark",
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias(
            "copy"
        ),
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"),
        (kind == 0).alias("gone"),
    )


def _read(turns: DataFrame) -> DataFrame:
    """The columns used, and what orders turns of the same number."""
    role, text = _spaced(F.col("role")), _spaced(F.col("text"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        role.alias("role0"),
        F.sha2(text, 256).alias("mark"),
    )


def given(turns: DataFrame) -> DataFrame:
    """Turns as they are, in the form that ``repaired`` reads."""
    return _read(turns).withColumns({"copy": F.lit(0), "gone": F.lit(False)})


ORDER = ("turn", "role0", "mark", "copy")


def faults(marked: DataFrame) -> DataFrame:
    """The turns that are there, with their first fault (0: none) and their role's initial."""
    text = F.col("text")
    own = (
        F.when(~text.rlike(f"[^{WHITE}]"), BLANK)
        .when(~text.rlike(f"[.!?][{WHITE}]*\\z"), TRUNCATED)
        .otherwise(OK)
    )
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    # what the window moves is narrow: a digest instead of role and text
    narrow = marked.where(~F.col("gone")).select(
        "conv_id",
        *ORDER,
        F.sha2(said, 256).alias("said"),
        F.substring("role", 1, 1).alias("initial"),
        own.alias("own"),
    )
    nth = F.row_number().over(Window.partitionBy("conv_id", "said").orderBy(*ORDER))
    repeated = (nth > 1) & (F.col("own") != BLANK)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("own"))
    return narrow.select("conv_id", *ORDER, "initial", fault.alias("fault"))


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPAIRED = (
    "conv_id long, position long, edit string, role string, text string, "
    + ", ".join(f"{name} long" for name in FIGURES)
    + ", audit string"
)
_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64())]
    + [(name, pa.string()) for name in ("edit", "role", "text")]
    + [(name, pa.int64()) for name in FIGURES]
    + [("audit", pa.string())]
)


class _Conversation:
    """One conversation while its records pass: faults first, then texts."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.initials, self.faults = [], bytearray()
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.audit: str | None = None
        self.at = self.state = self.position = 0

    def fault(self, turn: int | None, initial: str, fault: int) -> None:
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.illegal += 1
        self.initials.append(initial)
        self.faults.append(fault)
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn

    def _row(self, edit: str, role: str, text: str) -> dict:
        self.position += 1
        return {
            "conv_id": self.conv_id, "position": self.position - 1,
            "edit": edit, "role": role, "text": text,
        }

    def _solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest(self.initials, bytes(self.faults))
            self.n = 0

    def _inserted(self) -> Iterator[dict]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            self.state = NEXT_ROLE[self.state]
            yield self._row(INSERT, ROLE[self.state], "")

    def text(self, role: str, text: str) -> Iterator[dict]:
        """The repaired turns up to this one."""
        self._solve()
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == KEEP:
            self.state = KEPT[self.initials[self.n]][self.state]
            yield self._row(KEEP, role, text)
        elif edit == REROLE:
            self.state = NEXT_ROLE[self.state]
            yield self._row(REROLE, ROLE[self.state], text)
        self.n += 1

    def close(self) -> Iterator[dict]:
        """Turns inserted at the end, and the conversation's figures."""
        self._solve()
        yield from self._inserted()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        yield {
            "conv_id": self.conv_id,
            "gaps": gaps,
            "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE),
            "truncated": self.faults.count(TRUNCATED),
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": self.audit,
        }


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if current is None or row["conv_id"] != current.conv_id:
                if current:
                    out.extend(current.close())
                current = _Conversation(row["conv_id"])
            if row["fault"] is not None:
                current.fault(row["turn"], row["initial"], row["fault"])
            elif row["text"] is not None:
                out.extend(current.text(row["role"], row["text"]))
        yield pa.RecordBatch.from_pylist(out, _REPAIRED)
    if current:
        yield pa.RecordBatch.from_pylist(list(current.close()), _REPAIRED)


def repaired(marked: DataFrame) -> DataFrame:
    """Repaired turns with the edit that made them, and after those of each conversation a row of its
    figures (the one with an audit). Rows come conversation by conversation, in order."""
    ship(marked.sparkSession)
    there = ~F.col("gone")
    texts = marked.select(
        "conv_id",
        *ORDER,
        F.lit(None).cast("string").alias("initial"),
        F.lit(None).cast("int").alias("fault"),
        F.when(there, F.col("role")).alias("role"),
        F.when(there, F.col("text")).alias("text"),
    )
    nothing = F.lit(None).cast("string")
    first = faults(marked).withColumns({"role": nothing, "text": nothing})
    both = first.unionByName(texts).repartition("conv_id")
    in_order = both.sortWithinPartitions("conv_id", F.col("fault").isNull(), *ORDER)
    needed = in_order.select("conv_id", "turn", "initial", "fault", "role", "text")
    return needed.mapInArrow(_repair, REPAIRED)


RESULT = (
    "conv_id long, " + ", ".join(f"{name} long" for name in FIGURES)
    + ", audit string, repaired_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, any_turn = hashlib.sha256(), False
    schema = pa.schema(
        [("conv_id", pa.int64()), *((name, pa.int64()) for name in FIGURES)]
        + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["audit"] is None:
                said = f"{row['role']}:{row['text']}".encode()
                digest.update(b"\n" + said if any_turn else said)
                any_turn = True
            else:
                out.append(
                    {name: row[name] for name in ("conv_id", *FIGURES, "audit")}
                    | {"repaired_sha256": digest.hexdigest()}
                )
                digest, any_turn = hashlib.sha256(), False
        yield pa.RecordBatch.from_pylist(out, schema)


def figures(repaired_turns: DataFrame) -> DataFrame:
    """One row per conversation: its figures, audit and a digest of the repaired turns.

    For rows in the order ``repaired`` gives them."""
    return repaired_turns.mapInArrow(_digests, RESULT)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures(repaired(damaged(read_table(spark, sf_dir, "conversations"))))
