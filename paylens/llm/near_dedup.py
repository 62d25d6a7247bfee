"""Near-duplicate detection by a chosen-path similarity join.

Documents are sets of word shingles; equal sets form one class, so copies are never compared.
Each class has minwise tokens: for each of ``COORDINATES`` random orders of all shingles, the first
of its own. A tree sends a class down paths: a node picks a coordinate, with some luck a second
one, and sends its members on by their minwise token there, so that similar classes stay together.
Nodes small enough are compared exhaustively; others branch again. Several independent trees make
it near certain that a similar pair meets in one: at the similarity threshold a pair shares a first
node of one tree with probability 0.87, so 8 trees miss it once in 10^7.

Comparisons inside a node use the minwise tokens and keep whatever may be similar: a pair at the
threshold has fewer equal tokens with a chance of 1 in 10^7 at most, by the binomial distribution
(``least_equal``); every link is then confirmed on the full sets. Members that may be
similar to one of another component bring their full sets along, and pairs are compared until they
are connected. Only what connects classes matters for components, which saves most of the work: the
nodes of one tree come first, oversized ones as random blocks, and after that only nodes that hold
more than one component. Nodes too large for one task compare
pairs of blocks, or, with few members outside their largest component, these few with blocks of it.
Nodes of more than 32 blocks link what lies in the same random block and branch again, twice independently on each of the first levels, so that recall
does not fall with the depth there (``miss_rate``); what is still
as large beyond the last level is compared in pairs of blocks too. What is moved grows with the
members of nodes, never with their pairs.

Defined cases: a text without words has an empty set, is linked with nothing and keeps itself;
documents without doc_id come last; rows that repeat a doc_id share its verdict when their sets
agree; a component of documents without doc_id has a null component_id; the set of a
very long text is held whole by the tasks that make it and compare it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paylens.llm.common import LAST, id_and_text, order_key, read_table, saved, word_hashes

WORDS = 5
SIMILARITY = 0.85
COORDINATES = 128
TREES = 8
LEAF = 4000  # members of a node, or of a block of one, that one task compares exhaustively
BLOCKS = 32  # blocks of a node whose members are still compared exhaustively
MISS = 1e-7  # chance that a pair at the threshold is passed over by its sketches
COPIES, DOUBLED = 2, 6  # independent branchings below a node too large, and levels that have them
LEVELS = 40

_rng = np.random.default_rng(20240611)
_MULTIPLY = (_rng.integers(0, 2**31, COORDINATES, dtype=np.uint32) * 2 + 1).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, COORDINATES, dtype=np.uint32)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = _mixed(word_hashes(words))
    size = min(size, len(ids))
    n = len(ids) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = total * _FACTOR + ids[i : n + i]
    return np.unique(_mixed(total))


def minwise(tokens: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate, as 32-bit values."""
    short = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
    least = np.full(COORDINATES, 2**32 - 1, np.uint32)
    for start in range(0, len(short), 1024):
        part = short[start : start + 1024]
        np.minimum(least, (part * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1), out=least)
    return least


_BASE = "doc_id long, d long, t long, c binary, n long, minwise binary, sketch binary"


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                c, n, mins, sketches = [], [], [], []
                for text in part["text"].to_pylist():
                    tokens = shingles(text, size)
                    n.append(len(tokens))
                    c.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    least = minwise(tokens)
                    mins.append(least.tobytes() if n[-1] else b"")
                    sketches.append(least.astype(np.uint8).tobytes() if n[-1] else b"")
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["d"], part["t"], pa.array(c, pa.binary()), pa.array(n),
                     pa.array(mins, pa.binary()), pa.array(sketches, pa.binary())],
                    ["doc_id", "d", "t", "c", "n", "minwise", "sketch"],
                )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                sets = [shingles(t, size).tobytes() for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["c"], pa.array(sets, pa.binary())], ["c", "tokens"]
                )

    return run


def least_equal(similarity: float, miss: float = MISS) -> int:
    """The most equal minwise tokens that a pair at the threshold falls short of with chance miss."""
    below = 0.0
    for k in range(COORDINATES + 1):
        rest = COORDINATES - k
        below += math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** rest
        if below > miss:
            return k
    return COORDINATES


def miss_rate(similarity: float, level: int = 1, trees: int = TREES) -> float:
    """Chance that a pair at the threshold meets in no node of a level of any tree."""
    two, miss = 1 / similarity - 1, 0.0
    for at in range(level, 0, -1):
        below = miss ** (COPIES if at <= DOUBLED else 1) if at < level else 0.0
        apart = 1 - similarity * (1 - below)
        miss = (1 - two) * apart + two * apart**2
    return miss**trees


def _branches(path: Column, similarity: float) -> Column:
    """The coordinates a node branches on: one, and a second one with probability 1/s - 1."""
    luck = F.pmod(F.xxhash64(path, F.lit(2)), F.lit(1_000_000)) / 1_000_000
    first = F.pmod(F.xxhash64(path, F.lit(0)), F.lit(COORDINATES))
    second = F.pmod(F.xxhash64(path, F.lit(1)), F.lit(COORDINATES))
    two = (luck < 1 / similarity - 1) & (first != second)
    return F.when(two, F.array(first, second)).otherwise(F.array(first))


def _descend(members: DataFrame, similarity: float) -> DataFrame:
    """Members one level down: from tree, path, c, minwise to tree, path, c."""
    at = members.select(
        "tree", "path", "c", "minwise", F.explode(_branches(F.col("path"), similarity)).alias("k")
    )
    token = F.substring("minwise", (F.col("k") * 4 + 1).cast("int"), F.lit(4))
    return at.select("tree", F.xxhash64("path", "k", token).alias("path"), "c")


def _sized(members: DataFrame, name: str) -> DataFrame:
    """Members of nodes with at least two, with the size of their node."""
    members = saved(members, name)
    sizes = members.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    return members.join(saved(sizes, f"{name}-sizes"), "path")


def _candidates(node: dict, similarity: float, margin: float | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each member the later ones of other components that may be similar, closest first."""
    sketch, n, comp = node["sketch"], node["n"], node["comp"]
    least = least_equal(similarity)
    if margin is not None:
        least = (similarity - margin) * COORDINATES
    for i in range(len(n) - 1):
        same = (sketch[i + 1 :] == sketch[i]).sum(axis=1)
        fits = same >= least
        if fits.any():
            j = np.flatnonzero(fits) + i + 1
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            j = j[(comp[j] != comp[i]) & (small >= similarity * large)]
            if len(j):
                yield i, j[np.argsort(-same[j - i - 1], kind="stable")]


def _by_node(work, schema: pa.Schema):
    """Run work on the rows of one node after another; rows come sorted by path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            cuts = np.flatnonzero(np.diff(table["path"].to_numpy())) + 1
            if len(cuts) == 0:
                rest = table
                continue
            rest = table.slice(int(cuts[-1]))
            yield from nodes(table.slice(0, int(cuts[-1])), np.append(0, cuts))
        if rest is not None and rest.num_rows:
            yield from nodes(rest, np.array([0, rest.num_rows]))

    def nodes(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8)
        columns = {
            "path": table["path"].to_numpy(),
            "c": table["c"].to_pylist(),
            "n": table["n"].to_numpy(),
            "sketch": sketch.reshape(-1, COORDINATES),
            "comp": np.unique(np.array(table["comp"].to_pylist(), object), return_inverse=True)[1],
        }
        if "tokens" in table.column_names:
            # Views of the batch's memory, as the sets take most of it.
            columns["tokens"] = [x.as_buffer() for x in table["tokens"]]
        rows: list[tuple] = []
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if end - start > 1:
                rows += work({name: x[start:end] for name, x in columns.items()})
        cells = zip(*rows) if rows else [[] for _ in schema]
        arrays = [pa.array(x, field.type) for x, field in zip(cells, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])
_MEMBER = pa.schema([("path", pa.int64()), ("c", pa.binary())])


def _undecided(similarity: float, margin: float | None):
    """Members that may be similar to one of another component: path, c."""

    def work(node: dict) -> list[tuple]:
        marked = np.zeros(len(node["n"]), bool)
        for i, others in _candidates(node, similarity, margin):
            marked[i] = True
            marked[others] = True
        return [(int(node["path"][x]), node["c"][x]) for x in np.flatnonzero(marked).tolist()]

    return _by_node(work, _MEMBER)


def _node_links(similarity: float, margin: float | None):
    """Links on the full sets that connect the components of each node: a, b."""
    percent = round(100 * similarity)

    def work(node: dict) -> list[tuple]:
        sets = [np.frombuffer(x, np.uint64) for x in node["tokens"]]
        top, c, found = _Top(node["comp"]), node["c"], []
        for x, others in _candidates(node, similarity, margin):
            others = [y for y in others.tolist() if not top.same(x, y)]
            for start in range(0, len(others), 64):
                part = [y for y in others[start : start + 64] if not top.same(x, y)]
                for y, both in zip(part, _shared(sets[x], [sets[y] for y in part])):
                    union = len(sets[x]) + len(sets[y]) - both
                    if 100 * both >= percent * union and top.join(x, y):
                        found.append((c[x], c[y]))
        return found

    return _by_node(work, _PAIR)


def _shared(one: np.ndarray, others: list[np.ndarray]) -> list[int]:
    """How many tokens each of the other sorted sets shares with one."""
    if not others:
        return []
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    starts = np.cumsum([0] + [len(x) for x in others[:-1]])
    return np.add.reduceat((one[at] == joined).astype(np.int64), starts).tolist()


class _Top:
    """Union-find over the members of a node, begun with the components they have."""

    def __init__(self, comp: np.ndarray):
        first: dict[int, int] = {}
        self.above = [first.setdefault(label, at) for at, label in enumerate(comp.tolist())]

    def find(self, x: int) -> int:
        above = self.above
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def same(self, x: int, y: int) -> bool:
        return self.find(x) == self.find(y)

    def join(self, x: int, y: int) -> bool:
        """False if they were joined before."""
        x, y = self.find(x), self.find(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def _by_path(nodes: DataFrame, work, schema: str, *more: str) -> DataFrame:
    return (
        nodes.select("path", "c", "n", "sketch", "comp", *more)
        .repartition("path")
        .sortWithinPartitions("path", "c")
        .mapInArrow(work, schema)
    )


def _in_blocks(nodes: DataFrame, leaf: int) -> DataFrame:
    """Oversized nodes cut into random blocks of about ``leaf`` members, others in one."""
    count = F.ceil(F.col("size") / leaf)
    block = F.pmod(F.xxhash64("path", "c"), count)
    return nodes.withColumn("path", F.xxhash64("path", block))


def _oversized(nodes: DataFrame, leaf: int) -> DataFrame:
    return nodes.filter(F.col("size") > leaf).select("path", "c")


def _joined(comps: DataFrame, found: DataFrame) -> DataFrame:
    """Components once more links are found."""
    if found.isEmpty():
        return comps
    stars = comps.filter("c != comp").select(F.col("c").alias("a"), F.col("comp").alias("b"))
    return components(stars.union(found))


def components(links: DataFrame) -> DataFrame:
    """c and comp, the smallest c reachable, for every c in links (a, b).

    Labels sink to the smallest among the neighbours, then jump to their label's label, until
    nothing changes: about log(longest path) rounds, each written.
    """
    both = saved(
        links.select(F.col("a").alias("c"), F.col("b").alias("to"))
        .union(links.select(F.col("b").alias("c"), F.col("a").alias("to")))
        .distinct(),
        "links-both",
    )
    labels = saved(
        both.groupBy("c").agg(F.min("to").alias("to")).select("c", F.least("c", "to").alias("comp")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("c").alias("to"), "comp"), "to")
        sunk = (
            near.select("c", "comp", F.lit(None).cast("binary").alias("old"))
            .union(labels.select("c", "comp", F.col("comp").alias("old")))
            .groupBy("c")
            .agg(F.min("comp").alias("comp"), F.max("old").alias("old"))
        )
        sunk = saved(sunk, "labels-sunk")
        jump = sunk.select(F.col("c").alias("comp"), F.col("comp").alias("next"))
        seen = Observation()
        after = sunk.join(jump, "comp").select("c", F.col("next").alias("comp"), "old")
        changed = F.count_if(F.col("comp") != F.col("old")).alias("changed")
        labels = saved(after.observe(seen, changed), "labels").select("c", "comp")
        if not seen.get["changed"]:
            return labels


def _with_comp(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Members with their component, which is their own class if they have no link yet."""
    if comps is None:
        return members.withColumn("comp", F.col("c"))
    return members.join(comps, "c", "left").withColumn("comp", F.coalesce("comp", "c"))


def _mixed_nodes(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Members of nodes that hold several components; the largest one there, and how many others."""
    known = saved(_with_comp(members, comps), "node-members")
    counts = known.groupBy("path", "comp").agg(F.count("*").alias("k"))
    mixed = (
        counts.groupBy("path")
        .agg(
            F.max_by("comp", F.struct("k", "comp")).alias("main"),
            (F.sum("k") - F.max("k")).alias("others"),
        )
        .filter("others > 0")
    )
    return saved(known.join(saved(mixed, "node-mixed"), "path"), "mixed")


def _against_main(nodes: DataFrame, leaf: int) -> DataFrame:
    """Large nodes with few members outside the main component: these few, with every block of it."""
    count = F.ceil((F.col("size") - F.col("others")) / leaf).cast("int")
    own = F.pmod(F.xxhash64("c"), count).cast("int")
    blocks = F.when(F.col("comp") == F.col("main"), F.array(own)).otherwise(
        F.sequence(F.lit(0), count - 1)
    )
    dealt = nodes.withColumn("block", F.explode(blocks))
    return dealt.withColumn("path", F.xxhash64("path", "block")).drop("block")


def _blocks(nodes: DataFrame, leaf: int) -> DataFrame:
    """Nodes as pairs of blocks of about leaf / 2 members: each pair of members meets once or more."""
    count = F.ceil(F.col("size") / (leaf / 2)).cast("int")
    own = F.pmod(F.xxhash64("c"), count).cast("int")
    blocked = nodes.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), count - 1))
    )
    path = F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
    return blocked.withColumn("path", path).drop("own", "other")


def _sets_of(texts: DataFrame, classes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Full sets of the classes in members: c, tokens."""
    wanted = classes.join(members.select("c").distinct(), "c", "left_semi").select("c", "first.*")
    return saved(
        texts.select("d", "t", "text")
        .join(saved(wanted, "wanted").hint("merge"), ["d", "t"])  # the same plan at every size
        .select("c", "text")
        .mapInArrow(_full_sets(words), "c binary, tokens binary"),
        "full-sets",
    )


def similar_components(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    trees: int = TREES,
    leaf: int = LEAF,
    levels: int = LEVELS,
    blocks: int = BLOCKS,
    margin: float | None = None,
) -> DataFrame:
    """One row per document: doc_id, at, text_hash, n_shingles, component_id, kept."""
    texts = id_and_text(docs).select(
        "doc_id", order_key(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("t"), "text"
    )
    base = saved(texts.mapInArrow(_sets(words), _BASE), "shingle-sets")
    classes = saved(
        base.filter("n > 0")
        .groupBy("c")
        .agg(
            F.min(F.struct("d", "t")).alias("first"),
            F.min("n").alias("n"),
            F.min("minwise").alias("minwise"),
            F.min("sketch").alias("sketch"),
        ),
        "classes",
    )
    numbers = F.sequence(F.lit(1), F.lit(trees))
    roots = classes.select(F.explode(numbers).alias("tree"), "c", "minwise")
    members = _descend(roots.withColumn("path", F.xxhash64("tree")), similarity)
    told = classes.select("c", "n", "sketch")
    comps = sets = None
    for level in range(1, levels + 1):
        name = f"level{level}"
        nodes = saved(_sized(members, name).join(told, "c"), f"{name}-nodes")
        if level == 1:
            # Whoever may be similar to anyone is undecided in a node, or block, of some tree.
            cut = _in_blocks(_with_comp(nodes, None), leaf)
            similar = saved(
                _by_path(cut, _undecided(similarity, margin), "path long, c binary"), "similar"
            )
            sets = _sets_of(texts, classes, similar.union(_oversized(nodes, leaf)), words)
            tree = cut.filter("tree = 1").join(similar, ["path", "c"], "left_semi")
            links = _by_path(
                tree.join(sets, "c"),
                _node_links(similarity, margin),
                "a binary, b binary",
                "tokens",
            )
            comps = components(saved(links, "first-links"))

        mixed = _mixed_nodes(nodes, comps)
        small, large = (mixed.filter(x) for x in (F.col("size") <= leaf, F.col("size") > leaf))
        few, rest = large.filter(F.col("others") <= leaf), large.filter(F.col("others") > leaf)
        exhaustive = (F.col("size") <= leaf * blocks) | F.lit(level == levels)
        many = rest.filter(~exhaustive)
        compared = small
        for part in (
            _against_main(few, leaf),
            _blocks(rest.filter(exhaustive), leaf),
            _in_blocks(many, leaf),
        ):
            compared = compared.unionByName(part)
        undecided = _by_path(compared, _undecided(similarity, margin), "path long, c binary")
        undecided = saved(undecided, f"{name}-undecided")
        bring = compared.join(undecided, ["path", "c"], "left_semi").join(sets, "c")
        links = _by_path(
            bring, _node_links(similarity, margin), "a binary, b binary", "tokens"
        )
        comps = _joined(comps, saved(links, f"{name}-links"))
        if many.isEmpty():
            break
        below = many.select("tree", "path", "c").join(classes.select("c", "minwise"), "c")
        if level <= DOUBLED:
            copy = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
            below = below.withColumn("copy", copy)
            below = below.withColumn("path", F.xxhash64("path", "copy")).drop("copy")
        members = _descend(below, similarity)

    smallest = (
        classes.select("c", F.col("first.d").alias("d"))
        .join(comps, "c", "left")
        .withColumn("comp", F.coalesce("comp", "c"))
    )
    smallest = saved(smallest, "class-components")
    names = saved(smallest.groupBy("comp").agg(F.min("d").alias("low")), "component-names")
    verdicts = saved(smallest.join(names, "comp").select("c", "low"), "verdicts")
    own = F.when(F.col("n") > 0, F.when(F.col("low") != LAST, F.col("low"))).otherwise(F.col("doc_id"))
    return (
        base.join(verdicts, "c", "left")
        .withColumn("component_id", own)
        .select(
            "doc_id",
            F.col("d").alias("at"),
            F.col("t").alias("text_hash"),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents")).drop("at", "text_hash")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, one document of each component, with their columns."""
    kept = similar_components(docs, **options).filter("kept").select(
        F.col("at").alias("near_at"), F.col("text_hash").alias("near_hash")
    )
    keyed = docs.withColumns(
        {
            "near_at": order_key(F.col("doc_id").cast("long")),
            "near_hash": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )
    return keyed.join(kept.distinct(), ["near_at", "near_hash"], "left_semi").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM texts, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i)
    WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
    WHERE 100 * n_both >= 85 * (a.n + b.n - n_both)
), reach AS (
    SELECT x, y FROM links
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), lowest AS (
    SELECT x AS doc_id, least(x, min(y)) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""
