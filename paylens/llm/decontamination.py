"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, units after numbers, and names (capitalised words inside a sentence) become typed
placeholders, other words are lower-cased; so a question whose figures or names were changed
has the template of the original. With ``folded``, texts are compared once more without letter
case and with any white space as one blank, where names are words; one view has to cover an item.
Documents that share no gram of ``GRAM`` words with a window of the benchmark are left out first.
Both sides are cut into windows of ``width`` words of the template and joined by hash: the
benchmark at every word, a document at every ``stride``-th, by default also at every word, so that
every shared window is met. In documents that meet, windows are compared in full, and what stood
in the placeholders is checked: along one alignment of document and item, a value of the item must
always have been replaced by the same value; with ``per_window``, within every window by itself, so
that a value replaced in two ways takes only the windows that hold both. A document leaks an item
when consistent windows cover ``least`` words of the item, or all of it if it is shorter.

The join of all windows is left to Spark: the benchmark's side is broadcast only when the
written table is below the session's threshold, and shuffled otherwise.

``leaks`` by itself judges strictly; the query and the pipeline ask for all of ``WHOLE``.

Defined cases: null texts are empty; windows with fewer than ``literal`` ordinary words are no
evidence, nor are items of fewer than ``width`` words, unless ``short_items`` makes each of them
one window; an empty benchmark flags nothing; rows that
repeat doc_id and text give one result; rows that repeat an item count as one; item ids may be
null; very long texts are matched in pieces of ``PIECE`` windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import LAST, order_key, read_table, saved

WIDTH, STRIDE, LITERAL, LEAST = 8, 1, 4, 13
PIECE = 1024  # windows that begin in one piece of a text
GRAM = 5  # words of the grams by which texts are found that may hold a window
# What the query and the pipeline find beyond the strict defaults.
WHOLE = {"short_items": True, "per_window": True, "folded": True}

# Units that may follow a number.
UNITS = (
    "mm|cm|m|km|in|ft|yd|mi|miles?|inch(?:es)?|feet|foot|meters?|metres?|kilometers?|kilometres?|"
    "mg|g|kg|t|lbs?|oz|pounds?|grams?|kilograms?|ounces?|tons?|ml|l|liters?|litres?|gallons?|"
    "s|sec|seconds?|min|minutes?|h|hrs?|hours?|days?|weeks?|months?|years?|"
    "kmh|kph|mph|hz|khz|mhz|ghz|w|kw|mw|v|a|j|kj|n|pa|usd|eur|dollars?|euros?|cents?|percent"
)
_NUMBER, _UNIT, _NAME = "\ue001", "\ue002", "\ue003"  # private use: in no word
_NUMBERS = r"\p{N}+(?:[.,]\p{N}+)*"
_WORDS = r"[\p{L}\p{M}]+"
_TOKEN = f"{_NUMBERS}|{_WORDS}"
_MARKED = f"[{_NUMBER}{_UNIT}{_NAME}]|{_WORDS}"


def _plain(text: Column) -> Column:
    """Text without the characters that serve as placeholders; few texts have any."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    marked = text.contains(_NUMBER) | text.contains(_UNIT) | text.contains(_NAME)
    return F.when(marked, F.translate(text, _NUMBER + _UNIT + _NAME, "   ")).otherwise(text)


def values(text: Column) -> Column:
    """The words and numbers of a text, lower-cased."""
    return F.regexp_extract_all(F.lower(_plain(text)), F.lit(_TOKEN), F.lit(0))


def template(text: Column, named: bool = True) -> Column:
    """The same words and numbers, with placeholders for numbers, units and, if ``named``, names.

    The patterns begin with a blank and with a digit, so that most places are passed over at once.
    """
    names = _plain(text)
    if named:
        names = F.regexp_replace(
            names, r"\x20(?<=[\p{Ll},;]\x20)\p{Lu}[\p{L}\p{M}]*", f" {_NAME}"
        )
    units = F.regexp_replace(
        names, rf"(\p{{N}}\x20?)(?:{UNITS})(?![\p{{L}}\p{{M}}])", f"$1{_UNIT}"
    )
    numbers = F.regexp_replace(units, _NUMBERS, _NUMBER)
    return F.regexp_extract_all(F.lower(numbers), F.lit(_MARKED), F.lit(0))


def fold(text: Column) -> Column:
    """Text without letter case, with one blank for any white space: it has no names."""
    return F.lower(F.regexp_replace(text.cast("string"), r"[\s\p{Z}]+", " "))


def _views(text: Column, folded: bool) -> list[Column]:
    return [text, fold(text)] if folded else [text]


def _template(view: int, text: Column) -> Column:
    """The template of a view; the folded one has no names."""
    return template(text, named=view == 0)


def _cut_views(df: DataFrame, folded: bool, *keys: str) -> DataFrame:
    """keys, view, words and what stood in their places, for each view of ``text``."""
    cut = F.array(
        *(
            F.struct(_template(view, text).alias("words"), values(text).alias("stood"))
            for view, text in enumerate(_views(F.col("text"), folded))
        )
    )
    return df.select(*keys, F.posexplode(cut).alias("view", "cut")).select(*keys, "view", "cut.*")


def _every(hashes: Column, stride: int) -> Column:
    """Every ``stride``-th of the hashes."""
    return F.filter(hashes, lambda _, i: i % stride == 0) if stride > 1 else hashes


def _is_slot(word: Column) -> Column:
    return word.isin(_NUMBER, _UNIT, _NAME)


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _paired(hashes: Column, apart: Column | int) -> Column:
    """Hashes of each element with the one ``apart`` places on; as many as there are such pairs."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    on = F.slice(hashes, F.lit(1) + apart, n)
    return F.zip_with(F.slice(hashes, F.lit(1), n), on, lambda a, b: F.xxhash64(a, b))


def _with_window_hashes(df: DataFrame, hashes: str, widths: list[int], name: str) -> DataFrame:
    """The hashes of all windows of each width, from those of the words: {name}_{width}.

    Pairs, then fours, then eights are hashed from two each; other widths from two that overlap.
    """
    df, spans = df.withColumn(f"{name}_1", F.col(hashes)), [1]
    while spans[-1] * 2 <= max(widths):
        half = spans[-1]
        df = df.withColumn(f"{name}_{half * 2}", _paired(F.col(f"{name}_{half}"), half))
        spans.append(half * 2)
    for width in widths:
        if width not in spans:
            below = max(x for x in spans if x < width)
            df = df.withColumn(f"{name}_{width}", _paired(F.col(f"{name}_{below}"), width - below))
    return df


def _windows(df: DataFrame, widths: list[int], *keys: str) -> DataFrame:
    """Every window of ``words`` with what stood in its places: keys, at, hash, window, stood.

    Words are cut into pieces first, so that what is made of them in one row is bounded for texts
    of any length.
    """
    longest = max(widths)
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PIECE)),
        lambda start: F.struct(
            start.alias("start"),
            F.slice("words", start + 1, PIECE + longest - 1).alias("words"),
            F.slice("stood", start + 1, PIECE + longest - 1).alias("stood"),
        ),
    )
    cut = df.select(*keys, F.explode(pieces).alias("piece")).select(*keys, "piece.*")
    cut = cut.withColumn("hashes", _word_hashes(F.col("words")))
    cut = _with_window_hashes(cut, "hashes", widths, "hash")

    def of_width(width: int) -> Column:
        return F.transform(
            F.slice(f"hash_{width}", 1, PIECE),
            lambda h, i: F.struct(
                (F.col("start") + i).alias("at"),
                h.alias("hash"),
                F.slice("words", i + 1, width).alias("window"),
                F.slice("stood", i + 1, width).alias("stood"),
            ),
        )

    return cut.select(*keys, F.explode(F.concat(*map(of_width, widths))).alias("w")).select(
        *keys, "w.*"
    )


def benchmark_windows(
    benchmark: DataFrame,
    width: int = WIDTH,
    literal: int = LITERAL,
    short_items: bool = False,
    folded: bool = False,
):
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = _cut_views(own, folded, "item_id").dropDuplicates()
    widths = [*range(max(literal, 1), width if short_items else 0), width]
    cut = _windows(items.withColumn("n", F.size("words")), widths, "item_id", "view", "n")
    cut = cut.filter(F.size("window") == F.least(F.col("n"), F.lit(width)))
    words = F.size(F.filter("window", lambda x: ~_is_slot(x)))
    return saved(
        cut.filter(words >= literal).withColumnRenamed("at", "item_at"), "benchmark-windows"
    )


def _widths(items: DataFrame) -> list[int]:
    """The sizes of the benchmark's windows: ``width``, and those of shorter items."""
    return sorted(r[0] for r in items.select(F.size("window")).distinct().collect())


def _gram_step(widths: list[int]) -> tuple[int, int]:
    """Size and distance of grams such that every window holds a whole one, wherever it begins."""
    step = max(min(widths) - GRAM + 1, 1)
    return min(widths) - step + 1, step


def _grams(words: Column, size: int, step: int) -> Column:
    """Hashes of ``size`` consecutive words that begin at every ``step``-th word."""
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, size)))
    return F.coalesce(hashes, F.array().cast("array<long>"))


def _close(texts: DataFrame, items: DataFrame, widths: list[int], folded: bool) -> DataFrame:
    """text_hash of the texts that hold a gram of the items' windows: all that may match, and others."""
    size, step = _gram_step(widths)
    grams = saved(
        items.select(F.explode(_grams(F.col("window"), size, 1)).alias("gram")).distinct(),
        "benchmark-grams",
    )
    words = {f"words_{k}": _template(k, v) for k, v in enumerate(_views(F.col("text"), folded))}
    own = F.concat(*(_grams(F.col(name), size, step) for name in words))
    return saved(
        texts.select("text_hash", *(v.alias(name) for name, v in words.items()))
        .select("text_hash", F.explode(F.array_distinct(own)).alias("gram"))
        .join(grams, "gram", "left_semi")
        .select("text_hash")
        .distinct(),
        "benchmark-close",
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    stride: int = STRIDE,
    literal: int = LITERAL,
    least: int = LEAST,
    short_items: bool = False,
    per_window: bool = False,
    folded: bool = False,
) -> DataFrame:
    """Pairs of document and leaked item.

    short_items: items of fewer than ``width`` words leak where all of their template stands.
    per_window: slots are judged within each window instead of along the whole alignment.
    folded: texts are also compared without letter case and with any white space as one blank.

    at, text_hash: order key of the doc_id and hash of the text; doc_id, item_id; windows: matched;
    covered: words of the item; item_words; slots: placeholders matched; changed: those whose
    value differs.
    """
    keys = ["at", "text_hash"]
    items = benchmark_windows(benchmark, width, literal, short_items, folded)
    texts = docs.select(
        order_key(F.col("doc_id").cast("long")).alias("at"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    widths = _widths(items) or [width]
    views = {f"view_{k}": v for k, v in enumerate(_views(F.col("text"), folded))}
    close = _close(texts, items, widths, folded)
    templates = texts.join(close, "text_hash", "left_semi").select(
        "text_hash",
        *(_word_hashes(_template(k, v)).alias(name) for k, (name, v) in enumerate(views.items())),
    )
    for name in views:
        templates = _with_window_hashes(templates, name, widths, name)
    hashes = F.concat(
        *(
            _every(F.col(f"{name}_{w}"), stride if w == width else 1)
            for name in views
            for w in widths
        )
    )
    # Texts that meet are found by their hash alone; one that shares it by chance matches nothing.
    met = saved(
        templates.select("text_hash", F.explode(F.array_distinct(hashes)).alias("hash"))
        .join(items.select("hash").distinct(), "hash", "left_semi")
        .select("text_hash")
        .distinct(),
        "benchmark-met",
    )
    near = _cut_views(
        texts.join(met, "text_hash", "left_semi").dropDuplicates(keys), folded, *keys
    )
    matched = _match(near, items, widths, keys)
    slots = F.filter(
        F.zip_with(
            F.arrays_zip("window", "stood"),
            "doc_stood",
            lambda a, b: F.struct(
                a["window"].alias("kind"), a["stood"].alias("item"), b.alias("doc")
            ),
        ),
        lambda x: _is_slot(x["kind"]),
    )
    origin = F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x["item"])))
    consistent = F.size(F.array_distinct("slots")) == F.size(origin)
    matched = matched.withColumn("slots", slots)
    aligned = (
        (matched.filter(consistent) if per_window else matched)
        .groupBy(*keys, "item_id", "view", "n", (F.col("doc_at") - F.col("item_at")).alias("shift"))
        .agg(
            F.count("*").alias("windows"),
            F.collect_set("item_at").alias("starts"),
            F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
        )
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                F.flatten(F.collect_list("starts")),
                lambda i: F.sequence(i, F.least(i + width, F.col("n")) - 1),
            )
        )
    )
    changed = F.filter(
        F.array_distinct(F.flatten(F.collect_list("slots"))), lambda x: x["item"] != x["doc"]
    )
    found = (
        (aligned if per_window else aligned.filter(consistent))
        .groupBy(*keys, "item_id", "view", F.col("n").alias("item_words"))
        .agg(
            F.sum("windows").alias("windows"),
            F.size(covered).alias("covered"),
            F.size(F.array_distinct(F.flatten(F.collect_list("slots")))).alias("slots"),
            F.size(changed).alias("changed"),
        )
        .filter(F.col("covered") >= F.least(F.lit(least), F.col("item_words")))
    )
    # Of the views, the one that covers most, or the first of them.
    figures = ["windows", "covered", "slots", "changed"]
    best = F.max(F.struct("covered", (-F.col("view")).alias("order"), F.struct(*figures).alias("f")))
    found = (
        found.groupBy(*keys, "item_id", "item_words")
        .agg(best.alias("best"))
        .select(*keys, "item_id", "item_words", "best.f.*")
    )
    doc_id = F.when(F.col("at") != LAST, F.col("at"))
    return found.select(
        *keys, doc_id.alias("doc_id"), "item_id", "windows", "covered", "item_words", "slots",
        "changed",
    )


def _match(near: DataFrame, items: DataFrame, widths: list[int], keys: list[str]) -> DataFrame:
    """Windows of both sides that agree in full."""
    own = near.select(
        *(F.col(k).alias(f"key_{k}") for k in keys), "view", "words", "stood"
    )
    cut = _windows(own, widths, *(f"key_{k}" for k in keys), "view").select(
        *(F.col(f"key_{k}").alias(k) for k in keys),
        "view",
        F.col("at").alias("doc_at"),
        F.col("stood").alias("doc_stood"),
        "hash",
        "window",
    )
    return cut.join(items, ["view", "hash", "window"])


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return leaks(docs, benchmark, **WHOLE).drop("at", "text_hash")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that leak no item, with their columns."""
    flagged = leaks(docs, benchmark, **options).select(
        F.col("at").alias("leak_at"), F.col("text_hash").alias("leak_hash")
    )
    keyed = docs.withColumns(
        {
            "leak_at": order_key(F.col("doc_id").cast("long")),
            "leak_hash": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )
    return keyed.join(flagged.distinct(), ["leak_at", "leak_hash"], "left_anti").select(
        *docs.columns
    )
