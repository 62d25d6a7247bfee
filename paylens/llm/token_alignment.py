"""Cross-tokenizer alignment: where two tokenizers of the same text cut at the same bytes.

Tokenizer A is a byte-level BPE (``tokenizers`` JSON), B a sentencepiece model. Each text is encoded
as a space and the text (B adds the space), strings of special tokens as plain text. Both give an
ascending list of byte offsets where their tokens end. The lists are intersected by galloping: the
shorter one drives an exponential and then a binary search into the longer one, each search starting
where the one before ended. The common offsets cut the text into groups; the differences of their
ranks in either list are the ranges of tokens that overlap. All A-B pairs of tokens in a group are
linked, and a pair of ids counts once for every document that holds it linked.

How it runs: a task takes blocks of about ``BLOCK`` bytes of text, aligns all their texts at once in
numpy and writes one row per block: figures per document, the id pairs met in the block, and for
each document which of them it holds how often. The pairs of all blocks are added up per pair (a very
frequent pair is one row per block, added up before the shuffle), the highest count of each A id is
found, and every block gets the counts of its own pairs back. Nothing is sent to the driver; the
largest things held are a block's arrays, about 60 bytes for each byte of its text. A text longer
than ``BLOCK`` is a block by itself and is never cut, so a very long text needs that memory in a task.

Defined results: a null text counts as the empty text. Empty texts, and texts whose tokens joined are
not the space and the text (U+2581 in a text, characters that a model normalises), have no tokens:
zeros and ''. Null ids stay null; repeated rows are rows, and documents, like any others. An empty
table gives an empty result. Further columns are ignored.

In a group of m A and k B tokens all m*k pairs are links. Where that is more than ``WIDE``, equal ids
are combined before pairs are made, so a long stretch without a common end costs its distinct ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm.blocks import blocks
from paylens.llm.common import id_and_text, read_table, saved

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK = 2 << 20
SPACE = "▁"
LANE = 256  # consecutive searches of one lane
WIDE = 4096
AT_ONCE = 1 << 18  # bytes of text whose tokens are Python numbers at one time

# Fixed value: the pattern of the byte-level pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters, digits and blanks among these are the same in every Unicode version.
SETTLED = re.compile("[\x00-\u024f\u2010-\u2027]*")
LONG = 1000  # characters of a word or blank from which the slower, linear encoder is used
LONG_RUN = re.compile(rf"\S{{{LONG}}}|\s{{{LONG}}}")
# Between two characters that are not blank: both tokenizers cut before such a space.
SEGMENT = re.compile(r"(?<=\S) (?=\S)")
KEPT = 1 << 16  # segments whose tokens a worker remembers
KEPT_SIZE = 1 << 22  # their characters at most


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, the rest from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids of texts, and the bytes of each id.

    ``by_segment``: a text's ids are those of its segments one after another, as no token holds a
    space after another character, so a single space between words always begins a token.
    """

    by_segment = False

    def __init__(self, spelled: dict[int, bytes]):
        size = max(spelled) + 1
        self.bytes = [spelled.get(i, b"") for i in range(size)]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, size)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and the text."""
        raise NotImplementedError


class ByteLevel(Tokens):
    """A byte-level BPE from a ``tokenizers`` file.

    Where the ids are the ranks of the merges, which is checked against the file, tiktoken gives the
    same ids four times faster. It is used for texts of characters whose classes no Unicode version
    disputes and without very long words, which take it time with the square of their length.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        symbols = byte_symbols()
        spelled = {}
        for token, i in self.exact.get_vocab(with_added_tokens=True).items():
            plain = all(c in symbols for c in token)
            spelled[i] = bytes(map(symbols.__getitem__, token)) if plain else token.encode()
        super().__init__(spelled)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        cut = content.get("pre_tokenizer") or {}
        self.by_segment = (
            cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and not content.get("normalizer")
        )
        self.ranked = self._ranked(content["model"], spelled) if self.by_segment else None

    @staticmethod
    def _ranked(model: dict, spelled: dict[int, bytes]):
        import tiktoken

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {spelled[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        found: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            settled = text.isascii() or SETTLED.fullmatch(text)
            if self.ranked and settled and (len(text) < LONG or not LONG_RUN.search(text)):
                found[i] = self.ranked.encode_ordinary(" " + text)
            else:
                slow.append(i)
        given = [" " + texts[i] for i in slow]
        for i, got in zip(slow, self.exact.encode_batch_fast(given, add_special_tokens=False)):
            found[i] = got.ids
        return found


class Pieces(Tokens):
    """A sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled, crossing = {}, False
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece) if self.model.is_byte(i) else None
            spelled[i] = bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()
            crossing = crossing or SPACE in piece.lstrip(SPACE)
        super().__init__(spelled)
        self.by_segment = not crossing and self.joined(self.model.encode("a")) == b" a"

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _odd(segment: str) -> bool:
    """Whether a space beside the segment may belong to a longer blank token."""
    return not segment or segment[0].isspace() or segment[-1].isspace()


class Pair:
    """Both tokenizers, and the tokens of the segments a worker has met.

    Texts repeat their words, so a block's texts are looked up segment by segment; new segments are
    encoded together, as one text. The tokens of all segments lie one after another in two arrays.
    """

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.by_segment = self.a.by_segment and self.b.by_segment
        self.forget()

    def forget(self) -> None:
        # segments between single spaces; those at an end of a text with blanks of their own
        self.plain: dict[str, int] = {}
        self.odd: dict[str, int] = {}
        self.tokens: list[np.ndarray] = [NONE, NONE]
        self.starts = np.zeros((2, 1), np.int64)
        self.sound = np.empty(0, bool)
        self.size = 0

    def _learn(self, segments: list[str], kept: dict[str, int]) -> None:
        """Remember the tokens of new segments."""
        wanted = [b" " + s.encode() for s in segments]
        whole, lengths = b"".join(wanted), np.fromiter(map(len, wanted), np.int64, len(wanted))
        sound = np.ones(len(segments), bool)
        sides = []
        for by in (self.a, self.b):
            ids, ends = NONE, None
            if kept is self.plain:  # as one text, if it survives
                ids = np.array(by.encode([" ".join(segments)])[0], np.int32)
                if by.joined(ids.tolist()) == whole:
                    ends = np.searchsorted(by.lengths[ids].cumsum(), lengths.cumsum()) + 1
            if ends is None:
                each = by.encode(segments)
                ids = np.fromiter(chain.from_iterable(each), np.int32)
                ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)))
                sound &= [by.joined(ids) == said for ids, said in zip(each, wanted)]
            sides.append((ids, ends))
        self.starts = np.concatenate(
            [self.starts, [ends + len(t) for t, (_, ends) in zip(self.tokens, sides)]], axis=1
        )
        self.tokens = [np.concatenate([t, ids]) for t, (ids, _) in zip(self.tokens, sides)]
        first = len(self.sound)
        self.sound = np.concatenate([self.sound, sound])
        kept.update(zip(segments, range(first, first + len(segments))))
        self.size += sum(map(len, segments))

    def _places(self, texts: list[str]) -> list[list[int]]:
        """Where the tokens of each text's segments are."""
        if len(self.plain) + len(self.odd) > KEPT or self.size > KEPT_SIZE:
            self.forget()
        found, new, odd = [], {}, {}
        for text in texts:
            segments = text.split(" ") if self.by_segment else [text]
            unknown = set(segments).difference(self.plain)
            if not self.by_segment:
                odd.update(dict.fromkeys(segments))
            elif any(map(_odd, unknown)):
                segments = SEGMENT.split(text)
                ends = [s for s in (segments[0], segments[-1]) if _odd(s)]
                odd.update(dict.fromkeys(ends))
                unknown = set(segments).difference(self.plain, ends)
            if self.by_segment:
                new.update(dict.fromkeys(unknown))
            found.append(segments)
        new, odd = list(new), [s for s in odd if s not in self.odd]
        if new:
            self._learn(new, self.plain)
        if odd:
            self._learn(odd, self.odd)
        places = []
        for segments in found:
            first, last = self.odd.get(segments[0]), self.odd.get(segments[-1])
            if first is None and last is None:
                places.append(list(map(self.plain.__getitem__, segments)))
            else:
                inner = list(map(self.plain.__getitem__, segments[1:-1]))
                ends = [self.plain[s] if at is None else at
                        for s, at in ((segments[0], first), (segments[-1], last))]
                places.append([ends[0], *inner, *ends[1:][: len(segments) - 1]])
        return places

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of A and B, all texts one after another, and how many each text has by each.

        There are none where the tokens are not the space and the text.
        """
        places = self._places(texts)
        at = np.fromiter(chain.from_iterable(places), np.int64)
        edges = np.cumsum([0, *map(len, places)])
        unsound = np.add.reduceat(~self.sound[at], edges[:-1]) > 0
        ids, counts = [], np.empty((2, len(texts)), np.int64)
        for side in (0, 1):
            starts = self.starts[side]
            lengths = starts[at + 1] - starts[at]
            ends = lengths.cumsum()
            where = np.repeat(starts[at] - ends + lengths, lengths)
            ids.append(self.tokens[side][where + np.arange(len(where))])
            counts[side] = np.diff(np.concatenate([[0], ends])[edges])
        drop = np.array([not text for text in texts])
        for i in np.flatnonzero(unsound & ~drop):
            for side, by in enumerate((self.a, self.b)):
                end = counts[side, : i + 1].sum()
                mine = ids[side][end - counts[side, i] : end]
                drop[i] |= by.joined(mine.tolist()) != b" " + texts[i].encode()
        if drop.any():
            ids = [x[np.repeat(~drop, n)] for x, n in zip(ids, counts)]
            counts[:, drop] = 0
        return ids, counts


NONE = np.empty(0, np.int32)


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> Pair:
    """Loaded once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pair(a, b)


def gallop(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a`` and in ``b`` of the values that both ascending lists hold.

    The shorter list is dealt into lanes of ``LANE`` consecutive values which search side by side;
    in a lane every search starts where the one before ended.
    """
    if len(a) > len(b):
        there, here = gallop(b, a)
        return here, there
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    heads = np.arange(0, len(a), LANE)
    place = np.empty(len(a), np.int64)
    at = np.searchsorted(b, a[heads])  # where a lane begins
    last = len(b) - 1
    for step in range(min(LANE, len(a))):
        mine = heads + step
        if mine[-1] >= len(a):
            heads, mine, at = heads[:-1], mine[:-1], at[:-1]
            if not len(mine):
                break
        wanted = a[mine]
        # the first place not below the wanted value is after ``low`` and at most at ``high``
        low, high, width = at - 1, at.copy(), 1
        open_ = np.flatnonzero((b[np.minimum(high, last)] < wanted) & (high <= last))
        while len(open_):
            low[open_] = high[open_]
            high[open_] = np.minimum(high[open_] + width, last + 1)
            width *= 2
            reached = high[open_]
            below = (reached <= last) & (b[np.minimum(reached, last)] < wanted[open_])
            open_ = open_[below]
        open_ = np.flatnonzero(high - low > 1)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            below = b[middle] < wanted[open_]
            low[open_[below]] = middle[below]
            high[open_[~below]] = middle[~below]
            open_ = open_[high[open_] - low[open_] > 1]
        place[mine] = at = high
    found = np.flatnonzero((place <= last) & (b[np.minimum(place, last)] == a))
    return found, place[found]


@dataclass
class Aligned:
    """All texts of a block: tokens one text after another, and groups of them.

    Group g holds the A tokens from ``a_cut[g]`` to before ``a_cut[g + 1]``, the B tokens likewise, and
    ends at byte ``ends[g]`` of the block. Text d holds the A tokens from ``a_text[d]`` on, and so on.
    """

    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_cut: np.ndarray = field(init=False)
    b_cut: np.ndarray = field(init=False)
    ends: np.ndarray = field(init=False)
    group_text: np.ndarray = field(init=False)

    def cut(self, a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
        a_ends, b_ends = np.cumsum(a_lengths[self.a]), np.cumsum(b_lengths[self.b])
        in_a, in_b = gallop(a_ends, b_ends)
        self.ends = a_ends[in_a]
        self.a_cut = np.concatenate([[0], in_a + 1])
        self.b_cut = np.concatenate([[0], in_b + 1])
        self.group_text = np.searchsorted(self.a_cut, self.a_text)
        return self

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.a_cut), np.diff(self.b_cut)

    def per_text(self, of_groups: np.ndarray) -> np.ndarray:
        """Sums over the groups of each text."""
        total = np.concatenate([[0], np.cumsum(of_groups, dtype=np.int64)])
        return total[self.group_text[1:]] - total[self.group_text[:-1]]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, id pair (A in the upper half) and number of the links; equal ones not combined."""
        m, k = self.sizes
        product = m * k
        wide = np.flatnonzero(product > WIDE)
        product[wide] = 0
        group = np.repeat(np.arange(len(m)), product)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(product) - product, product)
        over = k[group]
        one = self.a[self.a_cut[group] + nth // over].astype(np.int64)
        other = self.b[self.b_cut[group] + nth % over]
        groups, pairs = [group], [one << 32 | other]
        times = [np.ones(len(group), np.int64)]
        for g in wide:
            ones, n_ones = np.unique(self.a[self.a_cut[g] : self.a_cut[g + 1]], return_counts=True)
            others, n_others = np.unique(
                self.b[self.b_cut[g] : self.b_cut[g + 1]], return_counts=True
            )
            pairs.append((ones.astype(np.int64)[:, None] << 32 | others[None, :]).ravel())
            times.append((n_ones[:, None] * n_others[None, :]).ravel())
            groups.append(np.full(len(pairs[-1]), g))
        return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)

    def written(self, n_a: int) -> Iterator[bytes]:
        """Per text: ``a1,a2|b1;a3|b2,b3``, ids in order."""
        m, k = self.sizes
        ends_a, ends_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        ends_a[self.a_cut[1:] - 1] = ends_b[self.b_cut[1:] - 1] = True
        codes = np.empty(len(self.a) + len(self.b), np.int32)
        codes[np.arange(len(self.a)) + np.repeat(self.b_cut[:-1], m)] = self.a * 2 + ends_a
        codes[np.arange(len(self.b)) + np.repeat(self.a_cut[1:], k)] = (self.b + n_a) * 2 + ends_b
        spelled = _spelled(n_a, int(self.b.max(initial=0)) + 1)
        text = self.a_text + self.b_text
        for start, end in zip(text[:-1].tolist(), text[1:].tolist()):
            yield b"".join(map(spelled.__getitem__, codes[start:end].tolist()))[:-1]


_spellings: list[bytes] = []


def _spelled(n_a: int, n_b: int) -> list[bytes]:
    """What stands for an id and whether it ends its side of a group."""
    if len(_spellings) < 2 * (n_a + n_b):
        _spellings.clear()
        for n, end in ((n_a, "|"), (max(n_b, 1 << 15), ";")):
            for i in range(n):
                _spellings.extend((b"%d," % i, f"{i}{end}".encode()))
    return _spellings


def encode(texts: list[str], pair: Pair) -> Aligned:
    """The texts aligned."""
    parts: list[tuple[list[np.ndarray], np.ndarray]] = []
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size < AT_ONCE):
            size += len(texts[end])
            end += 1
        parts.append(pair.encode(texts[start:end]))
        start = end
    ids = [np.concatenate([NONE, *(p[0][side] for p in parts)]) for side in (0, 1)]
    counts = np.concatenate([np.zeros((2, 1), np.int64), *(p[1] for p in parts)], axis=1)
    at = counts.cumsum(axis=1)
    return Aligned(*ids, *at).cut(pair.a.lengths, pair.b.lengths)


def _texts(block: pa.Table) -> list[str]:
    return block["text"].to_pylist()


GROUPS = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"


def align(docs: DataFrame, a: str = A_PATH, b: str = B_PATH) -> DataFrame:
    """Per document the ids of both tokenizers and, for each group, where it ends in either list.

    Group g (from 0) is made of the A tokens from a_cuts[g - 1] (0 for the first) to before a_cuts[g]
    and the B tokens likewise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK):
            found = encode(_texts(block), tokenizers(a, b))
            a_text, b_text, groups = found.a_text, found.b_text, found.group_text
            of_group = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
            columns = [block["doc_id"].combine_chunks()]
            for edges, values in (
                (a_text, found.a),
                (b_text, found.b),
                (groups, found.a_cut[1:] - a_text[of_group]),
                (groups, found.b_cut[1:] - b_text[of_group]),
            ):
                values = pa.array(values.astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values))
            names = ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return id_and_text(docs).mapInArrow(run, GROUPS)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, pairs array<long>, docs array<long>, "
    "held binary"
)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed cell."""
    table = pa.table([pa.array([a.tobytes()], pa.large_binary()) for a in arrays], names=list("stn"))
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(cell: bytes) -> list[np.ndarray]:
    table = pa.ipc.open_stream(cell).read_all()
    return [np.frombuffer(column[0].as_py(), np.int32) for column in table.columns]


def _block_row(number: int, block: pa.Table, by: Pair) -> dict:
    found = encode(_texts(block), by)
    m, k = found.sizes
    group, pair, times = found.links()
    which, pairs = pd.factorize(pair)
    n_texts = block.num_rows
    text = np.repeat(np.arange(n_texts), np.diff(found.group_text))[group]
    code = text * max(len(pairs), 1) + which
    if (times == 1).all():
        held, n = np.unique(code, return_counts=True)
    else:
        order = np.argsort(code, kind="stable")
        held, first = np.unique(code[order], return_index=True)
        n = np.add.reduceat(times[order], first) if len(first) else times
    text, which = np.divmod(held, max(len(pairs), 1))
    starts = np.searchsorted(text, np.arange(n_texts + 1))
    digests = [
        hashlib.sha256(said).hexdigest() if tokens else ""
        for said, tokens in zip(found.written(len(by.a.bytes)), np.diff(found.a_text).tolist())
    ]
    return {
        "block": number,
        "doc_id": block["doc_id"].to_pylist(),
        "n_a": np.diff(found.a_text),
        "n_b": np.diff(found.b_text),
        "n_groups": np.diff(found.group_text),
        "n_links": found.per_text(m * k),
        "groups_sha256": digests,
        "pairs": pairs,
        "docs": np.bincount(which, minlength=len(pairs)),
        "held": _packed(*(x.astype(np.int32) for x in (starts, which, n))),
    }


def _rows(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {
        "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    fields = [field.split(" ") for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[name] for r in rows], kinds[kind]) for name, kind in fields],
        [name for name, _ in fields],
    )


def aligned_blocks(docs: DataFrame, a: str = A_PATH, b: str = B_PATH) -> DataFrame:
    """One written row per block of documents, see the module."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for n, block in enumerate(blocks(batches, BLOCK)):
            yield _rows([_block_row(first + n, block, tokenizers(a, b))], BLOCKS)
        tokenizers(a, b).forget()  # idle workers stay for a while
        pa.default_memory_pool().release_unused()

    return saved(id_and_text(docs).mapInArrow(run, BLOCKS), "alignment")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a_id, b_id, pair, documents that hold it linked, and whether no pair of the A id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counted = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("documents"))
    counted = saved(counted.withColumn("a_id", F.shiftright("pair", 32)), "alignment-pairs")
    # at most one row per entry of A's vocabulary
    highest = counted.groupBy("a_id").agg(F.max("documents").alias("highest"))
    return counted.join(highest, "a_id").select(
        F.col("a_id").cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"),
        "pair",
        "documents",
        (F.col("documents") == F.col("highest")).alias("best"),
    )


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the counts of their pairs: the rows of their documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            held = row["held"][0].as_py()
            starts, which, n = _unpacked(held)
            answers = row["answers"].flatten()
            place, documents, best = (x.to_numpy(False) for x in answers.flatten())
            counts = np.zeros((2, len(place)), np.int64)
            counts[0, place], counts[1, place] = best, documents
            columns = {name: row[name].flatten() for name in ("doc_id", *FIGURES)}
            for name, of_pair in zip(("n_best", "count_sum"), counts):
                total = np.concatenate([[0], np.cumsum(of_pair[which] * n, dtype=np.int64)])
                columns[name] = pa.array(total[starts[1:]] - total[starts[:-1]])
            columns["groups_sha256"] = row["groups_sha256"].flatten()
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def figures(docs: DataFrame, a: str = A_PATH, b: str = B_PATH) -> DataFrame:
    """Per document: tokens, groups, links, links by the best pair of their A id, counts of links."""
    aligned = aligned_blocks(docs, a, b)
    asked = aligned.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = (
        asked.join(pair_counts(aligned).select("pair", "documents", "best"), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("place", "documents", "best")).alias("answers"))
    )
    none = F.array().cast("array<struct<place:int,documents:bigint,best:boolean>>")
    told = aligned.drop("pairs", "docs").join(answers, "block", "left")
    return told.withColumn("answers", F.coalesce("answers", none)).mapInArrow(_judged, RESULT)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures(read_table(spark, sf_dir, "documents"))
