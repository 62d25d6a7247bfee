from __future__ import annotations

import random
import regex

import pytest

from paylens.llm import decontamination
from paylens.llm.decontamination import UNITS, WHOLE, drop_leaks, leaks
from pyspark.sql import functions as F

NUM, UNIT, NAME = "", "", ""


def brute_words(text):
    """(template word, value) of a text."""
    text = regex.sub("[]", " ", text or "")
    out = []
    for m in regex.finditer(r"\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+", text):
        word = m[0]
        before = text[max(0, m.start() - 2) : m.start()]
        if regex.match(r"\p{N}", word):
            kind = NUM
        elif regex.search(r"[\p{Ll},;]\x20$", before) and regex.match(r"\p{Lu}", word):
            kind = NAME
        elif regex.search(r"\p{N}\x20?$", before) and regex.fullmatch(UNITS, word):
            kind = UNIT
        else:
            kind = word.lower()
        out.append((kind, word.lower()))
    return out


def brute(rows, items, width=8, literal=4, least=13):
    found = set()
    for doc_id, text in rows:
        doc = brute_words(text)
        for item_id, item_text in items:
            item, covered = brute_words(item_text), set()
            for shift in range(-len(item), len(doc)):
                starts = []
                for j in range(len(item) - width + 1):
                    i = j + shift
                    if i < 0 or i + width > len(doc):
                        continue
                    a, b = doc[i : i + width], item[j : j + width]
                    if [x[0] for x in a] == [x[0] for x in b]:
                        if sum(x[0] not in (NUM, UNIT, NAME) for x in b) >= literal:
                            starts.append(j)
                pairs = {
                    (item[j + k][0], item[j + k][1], doc[j + k + shift][1])
                    for j in starts
                    for k in range(width)
                    if item[j + k][0] in (NUM, UNIT, NAME)
                }
                if len(pairs) == len({p[:2] for p in pairs}):
                    covered |= {j + k for j in starts for k in range(width)}
            if len(covered) >= min(least, len(item)) and covered:
                found.add((doc_id, item_id))
    return found


QUESTION = (
    "A train with Anna leaves at 10 km per hour and meets Bob after 3 hours, then Anna walks 10 "
    "steps back to the old station while Bob waits for her with 25 kg of fresh apples."
)


def run(docs, benchmark, **options):
    return {(r["doc_id"], r["item_id"]) for r in leaks(docs, benchmark, **options).collect()}


@pytest.fixture(scope="module")
def bench(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


def test_changed_figures_and_names(table, bench, with_clashes):
    def changed(**by):
        text = QUESTION
        for old, new in by.items():
            text = text.replace({"ten": "10", "unit": "kg"}.get(old, old), new)
        return f"Some words before it. {text} And some after it."

    rows = [
        (1, changed()),
        (2, changed(ten="17.5", Anna="Maria", Bob="Zoë", unit="lb")),
        (3, changed(Anna="Maria").replace("then Maria", "then Peter")),  # one name became two
        (4, "A train of thought that has nothing to do with any question at all, said Anna."),
        (5, changed().upper()),
        (None, changed()),
        (1, changed()),
        (7, None),
        (8, ""),
    ]
    items = [(10, QUESTION), (10, QUESTION), (11, None), (12, "too short"), (None, QUESTION[::-1])]
    found = leaks(with_clashes(table(rows)), with_clashes(bench(items)))
    assert sorted(((r["doc_id"], r["item_id"]) for r in found.collect()), key=str) == sorted(
        [(1, 10), (2, 10), (None, 10)], key=str
    )
    changed_slots = {r["doc_id"]: r["changed"] for r in found.collect()}
    assert changed_slots[1] == 0 and changed_slots[2] == 4
    docs = with_clashes(table(rows))
    out = drop_leaks(docs, bench(items))
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 4, 5, 7, 8]


def test_against_brute_force(table, bench):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("ro", "li", "né", "st")] + ["km", "10", "3,5"]
    names = ["Anna", "Bob", "Éva"]

    def words(n):
        return [rng.choice(names) if rng.random() < 0.1 else rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(words(rng.randrange(6, 40)))) for i in range(25)]
    rows = []
    for i in range(60):
        text = words(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split()
            start = rng.randrange(len(part))
            part = part[start : start + rng.randrange(8, 40)]
            if rng.random() < 0.5:
                swap = {x: rng.choice(["7", "99", "Tom", "Ida"]) for x in names + ["10", "3,5"]}
                part = [swap.get(x, x) if rng.random() < 0.9 else x for x in part]
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        rows.append((i, " ".join(text)))
    got = run(table(rows), bench(items), stride=1)
    assert got == brute(rows, items) and len(got) > 10
    # A wider stride finds whatever shares eleven words in a row.
    assert run(table(rows), bench(items)) <= got


def test_supplied_passages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    whole = (
        docs.alias("d")
        .join(benchmark.alias("b"), F.expr("contains(d.text, b.text)"))
        .select("doc_id", "item_id")
    )
    assert {tuple(r) for r in whole.collect()} <= run(docs, benchmark)


def test_empty(table, bench):
    assert run(table([]), bench([(1, QUESTION)])) == set()
    assert run(table([(1, QUESTION)]), bench([])) == set()


def test_every_window_and_short_items(table, bench):
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("ro", "li", "ne", "sta")]
    items = [(n, " ".join(words[n : n + n])) for n in (5, 8, 9, 10)] + [(20, " ".join(words[:20]))]
    rows = []
    for before in range(8):  # every place relative to a stride
        pre = " ".join(["zz"] * before)
        rows += [(100 * n + before, f"{pre} {text} yy") for n, text in items[:4]]
        edited = " ".join(words[:9] + ["xx"] + words[10:19])
        rows.append((2000 + before, f"{pre} {edited} yy"))
    got = run(table(rows), bench(items), **WHOLE)
    assert {(100 * n + i, n) for n, _ in items[:4] for i in range(8)} <= got
    assert {(2000 + i, 20) for i in range(8)} <= got
    strict = run(table(rows), bench(items))
    assert strict == brute(rows, items) == {p for p in got if p[1] != 5}


def test_brute_force_at_the_defaults(table, bench):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ro", "li", "ne")] + ["10", "km"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 18)))) for i in range(20)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randrange(40))]
        part = rng.choice(items)[1].split()
        start = rng.randrange(3)
        at = rng.randrange(len(text) + 1)
        text[at:at] = part[start : start + rng.randrange(8, 18)]
        rows.append((i, " ".join(text)))
    got = run(table(rows), bench(items))
    assert got == brute(rows, items) and len(got) > 5


def test_inconsistent_slot_takes_its_windows_only(table, bench):
    rows = [
        (1, QUESTION.replace("then Anna", "then Maria")),
        (2, QUESTION.replace("10 km", "12 km").replace("10 steps", "15 steps")),
        (3, QUESTION.replace("10 steps", "11 steps")),
        (4, "Now x said that Ida and Tom like Ida and Jim a lot, but then rain came down."),
    ]
    # One name became two within every window that could match.
    items = [(10, QUESTION), (11, "Now x said that Bob and Tom like Bob and Tom a lot")]
    assert run(table(rows), bench(items), **WHOLE) == {(1, 10), (2, 10), (3, 10)}
    assert run(table(rows), bench(items)) == brute(rows, items) == set()


def test_other_case_and_white_space(table, bench):
    reflowed = QUESTION.replace(" with Anna", "\nwith  Anna").replace(" Bob", "\nBob").replace("25 kg", "30 kg")
    german = "Der Hund und die Katze sahen den Vogel im Garten, als der Regen auf das Dach fiel und Wind kam"
    rows = [
        (1, QUESTION.upper()), (2, QUESTION.lower()), (3, reflowed.replace(" Anna", "\nAnna")),
        (4, german.lower()), (5, german.upper()), (6, german), (7, QUESTION), (8, "nothing of it"),
    ]
    items = [(10, QUESTION), (11, german)]
    want = {(1, 10), (2, 10), (3, 10), (7, 10), (4, 11), (5, 11), (6, 11)}
    found = leaks(table(rows), bench(items), **WHOLE).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(want)
    assert all(r["covered"] == r["item_words"] for r in found if r["doc_id"] != 3)
    assert not {1, 4, 5} & {doc_id for doc_id, _ in run(table(rows), bench(items))}


@pytest.mark.parametrize("widths", [[1], [3, 8], [4, 5, 6, 7, 8], [5], [7, 8], [8], [20]])
def test_every_window_holds_a_whole_gram(widths):
    size, step = decontamination._gram_step(widths)
    assert 1 <= size <= min(widths)
    for width in widths:
        for begin in range(3 * width):
            starts = range(0, begin + width, step)
            assert any(begin <= at and at + size <= begin + width for at in starts)


@pytest.mark.parametrize("short", [False, True])
def test_texts_without_a_gram_of_the_benchmark_are_left_out_first(spark, short):
    item = "seven grey boats drifted beyond the quiet harbour wall while children sang old songs"
    rows = [(i, "many other words " * i + item + " and more") for i in range(8)]
    rows += [(8, "nothing of it stands in this text, which is about other things"), (9, ""), (10, None)]
    rows += [(11, "ONE short one HERE and then some words")]
    items = [(1, item)] + [(2, "a short one here")] * short
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in leaks(docs, bench, **WHOLE).collect()}
    assert found == {(i, 1) for i in range(8)}
    windows = decontamination.benchmark_windows(bench, short_items=True, folded=True)
    texts = docs.fillna("").withColumn("text_hash", F.xxhash64("text"))
    widths = decontamination._widths(windows)
    close = decontamination._close(texts, windows, widths, True)
    kept = {r["doc_id"] for r in texts.join(close, "text_hash", "left_semi").collect()}
    assert kept == set(range(8))
