"""Chat formatting against plain code, exact round trips of hostile texts, and typed parts."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from paylens.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"
HOSTILE = ["\\", "<", ">", "</turn>\n", "<turn:user>\n", "<image 1>", "<image ", "</tur", "n>", "\n", "é", "x", ""]


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 7)):
            text = "".join(rng.choice(HOSTILE) for _ in range(rng.randrange(12)))
            role = rng.choice(["user", "assistant", "system", None, "a<b>\\c\nd", ""])
            rows.append((conv, rng.choice([turn, None]), role, rng.choice([text, text, None])))
    rows += rows[:5] + [(7, 99, "assistant", "long " * 60_000)]
    return rows


def expected(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, found in conversations.items():
        found = [x[2:] for x in sorted(found)]
        learned = "".join(text for role, text in found if role == "assistant")
        out[conv] = (
            len(found),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in found).encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
        )
    return out


def test_digests_against_plain_code(spark, turns):
    formatted = C.format_turns(spark.createDataFrame(turns, SCHEMA).repartition(3), tokenizer=None)
    got = {r.conv_id: tuple(r)[1:5] for r in C.digests(formatted).collect()}
    assert got == expected(turns)


def test_joined_text_reads_back_and_offsets_hold(spark, turns):
    formatted = C.format_turns(spark.createDataFrame(turns, SCHEMA), tokenizer=None)
    for row in C.joined(formatted).collect():
        read = [(role, "".join(parts)) for role, parts in C.read_back(row.formatted)]
        mine = sorted(
            (t is not None, t or 0, r or "", x or "") for c, t, r, x in turns if c == row.conv_id
        )
        assert read == [x[2:] for x in mine]
        learned = "".join(C.unescape(row.formatted[s.start : s.end]) for s in row.loss)
        assert learned == "".join(x[3] for x in mine if x[2] == "assistant")


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.text(), st.lists(st.sampled_from(HOSTILE)).map("".join))))
def test_any_text_round_trips(rows):
    visitor = C.Visitor(C.Expansion())
    said = [visitor.turn(role, [{"type": "text", "text": text}])["segment"] for role, text in rows]
    assert [(r, "".join(p)) for r, p in C.read_back("".join(said))] == rows


PARTS = [
    {"type": "text", "text": "see <image"},
    {"type": "text", "text": " 1> and "},
    {"type": "image", "ref": "s3://a.png", "width": 57, "height": 28},
    {"type": "audio", "ref": "b.wav", "seconds": 1.01},
    {"type": "text", "text": None},
    {"type": "document", "ref": "c.pdf", "pages": 3},
    {"type": "image"},
]


def test_typed_parts(spark):
    full = [{k: p.get(k) for k in "type text ref width height seconds pages".split()} for p in PARTS]
    rows = [(1, 0, "user", None, full), (1, 1, "assistant", "fine", None), (1, 2, "user", "x", [])]
    df = spark.createDataFrame(rows, f"{SCHEMA}, parts array<{C.PART}>")
    (row,) = C.joined(C.format_turns(df, "parts", None)).collect()
    assert row.formatted == (
        "<turn:user>\nsee \\<image 1> and <image 1><audio 2><document 3><image 4></turn>\n"
        "<turn:assistant>\nfine</turn>\n<turn:user>\n</turn>\n"
    )
    found = [(a.number, a.type, a.ref, a.tokens) for a in row.attachments]
    assert found == [
        (1, "image", "s3://a.png", 3), (2, "audio", "b.wav", 26), (3, "document", "c.pdf", 3072),
        (4, "image", None, 1),
    ]
    for a in row.attachments:
        assert row.formatted[a.start :].startswith(f"<{a.type} {a.number}>")
    assert row.n_tokens == 3 + 26 + 3072 + 1
    (_, parts), *_ = C.read_back(row.formatted)
    assert parts == ["see <image 1> and ", ("image", 1), ("audio", 2), ("document", 3), ("image", 4)]


def test_tokens_of_texts_and_placeholders(spark):
    part = {k: None for k in "type text ref width height seconds pages".split()}
    image = part | {"type": "image", "width": 280, "height": 28}
    rows = [(1, 0, "user", None, [image]), (1, 1, "user", "hello world", None)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, parts array<{C.PART}>")
    count = C._counter(C.TOKENIZER)
    ends = count("<turn:user>\n") + count("</turn>\n")
    got = [r.n_tokens for r in C.format_turns(df, "parts").orderBy("position").collect()]
    assert got == [ends + 10, ends + count("hello world")]


def test_parts_from_json(spark):
    rows = [('[{"type": "image", "ref": "a", "width": 3}]',), ("[not json",), ("plain",), (None,)]
    df = spark.createDataFrame(rows, "c string").select(C.parts_from_json(C.F.col("c")).alias("p"))
    got = [[(p.type, p.text, p.ref, p.width) for p in r.p] for r in df.collect()]
    assert got == [
        [("image", None, "a", 3)], [("text", "[not json", None, None)],
        [("text", "plain", None, None)], [("text", None, None, None)],
    ]


def test_unknown_part_raises(spark):
    part = {k: None for k in "type text ref width height seconds pages".split()} | {"type": "smell"}
    df = spark.createDataFrame([(1, 0, "user", None, [part])], f"{SCHEMA}, p array<{C.PART}>")
    with pytest.raises(PythonException, match="smell"):
        C.format_turns(df, "p", None).collect()


def test_empty_table_and_clashing_columns(spark, turns, with_clashes):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.digests(C.format_turns(empty)).collect() == [] == C.joined(C.format_turns(empty)).collect()
    names = "position segment start loss parts n_tokens attachments".split()
    df = spark.createDataFrame(turns, SCHEMA)
    extra = with_clashes(df).withColumns({name: C.F.lit("x") for name in names})
    assert {tuple(r)[:5] for r in C.digests(C.format_turns(extra, tokenizer=None)).collect()} == {
        (c, *v) for c, v in expected(turns).items()
    }
