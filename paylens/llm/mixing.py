"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is wanted ``target / source_size`` times: its whole part is taken at
once, and the fraction is rounded so that the words taken from the source stay at the target.
Two fractional documents meet, and mass (copies times words) moves between them, in a random
direction with fair odds, until one of them is taken in full or not at all. What is left of
the other goes on to meet the next. Documents meet in small groups; each group leaves at most
one fractional document, and these meet again in groups one level up, so that a source of any
size is a tree of bounded groups. The last one left in a source is rounded by a coin toss.
The words taken from a source therefore miss its target by less than one document.

Only DataFrame operations are used. All random numbers are hashes of the seed, the level and
the document, so that reruns and retried tasks agree.

Defined cases: documents without words are taken 0 times (``taken`` 0); a null source is a
source of its own and comes last; repeated rows are documents of their own, told apart by
a running number; of a very long text only its number of words goes on; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import WHITE, order_key, read_table, saved

WEIGHTS = (3.0, 1.0, 2.0)  # by source in code point order, repeating
SHARE = 1.5  # words wanted, as a share of all words
MOST = 2.0  # no source, and no document, is taken more often
GROUP = 32  # documents that meet in one group
SEED = 20240229

_ITEM = "struct<doc_id:bigint,copy:bigint,size:bigint,p:double>"
_DONE = "array<struct<doc_id:bigint,copy:bigint,size:bigint,up:int>>"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST):
    """Words wanted of each source: one row per source with source_size and target.

    Each source gets its weight's part of the total, up to ``most`` times its size; what is cut
    there goes to the others by weight. In order of size limit over weight, the sources at
    their limit come first, so the common level is found in one pass over the sources.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1))
    ranked = by_source.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    fill = Window.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    rest = share * F.sum("source_size").over(whole) - (F.sum("limit").over(fill) - F.col("limit"))
    open_weight = F.sum("weight").over(whole) - (F.sum("weight").over(fill) - F.col("weight"))
    levelled = ranked.withColumn("level", rest / open_weight)
    at_level = F.col("level") * F.col("weight") <= F.col("limit")
    # Once a level fits, later ones are lower, so the first that fits is the highest.
    common = F.max(F.when(at_level, F.col("level"))).over(whole)
    target = F.least(F.col("limit"), F.coalesce(common * F.col("weight"), F.col("limit")))
    return levelled.withColumn("target", target).select("source", "source_size", "n", "target")


def _meet(carry: Column, item: Column, seed: int, level: int) -> tuple[Column, Column]:
    """Move mass between two fractional documents; (carry's p, item's p) of the two ends."""
    a, b = carry["p"], item["p"]
    ma, mb = carry["size"].cast("double"), item["size"].cast("double")
    up = F.least((1 - a) * ma, b * mb)  # mass that carry can take from item
    down = F.least(a * ma, (1 - b) * mb)  # mass that carry can give to item
    coin = _uniform(seed, level, carry["doc_id"], carry["copy"], item["doc_id"], item["copy"])
    rises = coin * (up + down) < down
    a_up = F.when((1 - a) * ma <= b * mb, F.lit(1.0)).otherwise(a + up / ma)
    b_up = F.when((1 - a) * ma >= b * mb, F.lit(0.0)).otherwise(b - up / mb)
    a_down = F.when(a * ma <= (1 - b) * mb, F.lit(0.0)).otherwise(a - down / ma)
    b_down = F.when(a * ma >= (1 - b) * mb, F.lit(1.0)).otherwise(b + down / mb)
    return F.when(rises, a_up).otherwise(a_down), F.when(rises, b_up).otherwise(b_down)


def _uniform(seed: int, level: int, *keys: Column) -> Column:
    """A number in [0, 1) from a hash of the keys."""
    bits = F.xxhash64(F.lit(seed), F.lit(level), *keys)
    return F.pmod(bits, F.lit(2**52)) / float(2**52)


def _item(item: Column, p: Column) -> Column:
    return F.struct(
        item["doc_id"].alias("doc_id"),
        item["copy"].alias("copy"),
        item["size"].alias("size"),
        p.alias("p"),
    )


def _decided(item: Column, p: Column) -> Column:
    return F.struct(
        item["doc_id"].alias("doc_id"),
        item["copy"].alias("copy"),
        item["size"].alias("size"),
        p.cast("int").alias("up"),
    )


def _settle(items: Column, seed: int, level: int) -> Column:
    """Let the documents of one group meet one after another: struct<carry, done>."""

    def step(acc: Column, item: Column) -> Column:
        # The values that a meeting leads to are bound once, by a lambda over an array of one.
        a, b = _meet(acc["carry"], item, seed, level)
        met = F.transform(
            F.array(F.struct(acc.alias("acc"), item.alias("item"), a.alias("a"), b.alias("b"))),
            lambda m: _after(m["acc"], m["item"], m["a"], m["b"]),
        )
        first = F.struct(_item(item, item["p"]).alias("carry"), acc["done"].alias("done"))
        return F.when(acc["carry"].isNull(), first).otherwise(F.element_at(met, 1))

    none = F.struct(
        F.lit(None).cast(_ITEM).alias("carry"), F.array().cast(_DONE).alias("done")
    )
    return F.aggregate(items, none, step)


def _after(acc: Column, item: Column, a: Column, b: Column) -> Column:
    a_open, b_open = (a > 0) & (a < 1), (b > 0) & (b < 1)
    carry = F.when(a_open, _item(acc["carry"], a)).when(b_open, _item(item, b))
    done = F.concat(
        acc["done"],
        F.when(a_open, F.array().cast(_DONE)).otherwise(F.array(_decided(acc["carry"], a))),
        F.when(b_open, F.array().cast(_DONE)).otherwise(F.array(_decided(item, b))),
    )
    return F.struct(carry.cast(_ITEM).alias("carry"), done.cast(_DONE).alias("done"))


def pivotal_rounding(items: DataFrame, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """Round fractional copies within each source, up the tree of groups.

    items: source, doc_id, copy, size (> 0), p in (0, 1); returns them with ``up`` 0 or 1
    instead of p. Every level is written, so a lost executor costs part of one level.
    """
    cols = ["source", "doc_id", "copy", "size"]
    decided, level = [], 0
    left = items.select(*cols, "p")
    counts = saved(left.groupBy("source").agg(F.count("*").alias("n")), "mix-counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    for level in range(1, 2 + math.ceil(math.log(max(most, 2), group))):
        buckets = F.ceil(F.col("n") / F.lit(float(group) ** level))
        spread = F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "copy"), buckets)
        grouped = (
            left.join(counts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .select(*cols, "p", spread.alias("bucket"))
            .groupBy("source", "bucket")
            .agg(
                F.sort_array(
                    F.collect_list(
                        F.struct(
                            F.xxhash64(F.lit(seed - level), "doc_id", "copy").alias("at"),
                            "doc_id", "copy", "size", "p",
                        )
                    )
                ).alias("items")
            )
            .select("source", _settle(F.col("items"), seed, level).alias("x"))
            .select("source", "x.carry", "x.done")
        )
        settled = saved(grouped, f"mix-level{level}")
        decided.append(settled.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        left = settled.filter("carry is not null").select("source", "carry.*")
        if most <= float(group) ** level:
            break
    toss = _uniform(seed, -1, F.col("doc_id"), F.col("copy")) < F.col("p")
    out = left.select(*cols, toss.cast("int").alias("up"))
    for part in decided:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED, group=GROUP):
    """How often each document is taken: doc_id, source, size, source_size, target, copies."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(f"[^{WHITE}]+"))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words.cast("long").alias("size"),
    )
    # Repeated rows become one row each again, with a number that tells them apart.
    distinct = counted.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    sizes = saved(
        distinct.select(
            "doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy")
        ),
        "mix-sizes",
    )
    targets = saved(source_targets(sizes, weights, share, most), "mix-targets").select(
        F.col("source").alias("of"), "source_size", "target"
    )
    wanted = sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "times", F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )
    wanted = wanted.withColumn("whole", F.floor("times")).withColumn(
        "p", F.col("times") - F.col("whole")
    )
    rounded = pivotal_rounding(wanted.filter("p > 0"), group, seed)
    cols = ["doc_id", "source", "copy", "size"]
    parts = wanted.filter("p = 0").select(*cols, F.lit(0).alias("up")).unionByName(rounded)
    times = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return parts.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        *cols, "source_size", "target", (F.floor(times) + F.col("up")).cast("long").alias("copies")
    )


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as they are taken, with the number of the copy as ``mix_copy``.

    Rows that agree in doc_id, source and size are dealt the copies of their rows in mix() in
    any order; which of two identical rows gets which does not matter.
    """
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(f"[^{WHITE}]+")).cast("long")
    keys = ["mix_doc", "mix_source", "mix_size"]

    def keyed(df: DataFrame, size) -> DataFrame:
        source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
        return df.withColumns(
            {"mix_doc": order_key(F.col("doc_id").cast("long")), "mix_source": source, "mix_size": size}
        )

    taken = (
        keyed(mix(docs, **options), F.col("size"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("copies"), asc=False).alias("mix_copies"))
        .filter("mix_copies[0] > 0")
    )
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("mix_doc"))
    joined = keyed(docs, words).join(taken, keys).withColumn("mix_row", number)
    times = F.element_at("mix_copies", F.col("mix_row"))
    return joined.filter(times > 0).select(
        *docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("mix_copy")
    )
