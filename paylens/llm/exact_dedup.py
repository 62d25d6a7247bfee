"""Exact deduplication with a stateful stream.

Documents arrive as a stream of (digest, stable identifier, content locator). The stream is
grouped by digest without a watermark, so its state never expires; the state lives in RocksDB
on the executors' disks, with its checkpoint in the shared folder, and keeps for each digest
the number of documents, the smallest doc_id and the file that holds that document. Rows are
combined before they reach the state, so a digest with a third of all rows costs one row per
task and batch. A restart goes on from the checkpoint.

A digest that was hit is only a claim: the normalised text of every document of such a group is
compared in full with the text that the locator names. Texts that differ despite equal digests
become groups of their own.

Defined cases: null text is the empty text; documents without doc_id come last; rows that
repeat both doc_id and text count in ``group_size`` and at most one of them is kept;
a very long text is hashed and compared whole, as one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import WHITE, order_key, read_table, saved, scratch

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
_UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
_BUFFER = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"
FILES_PER_BATCH = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")


def text_digest(norm: Column, digits: int) -> Column:
    return F.substring(F.sha2(norm, 256), 1, digits)


def arrive(docs: DataFrame, digits: int) -> str:
    """Write what the stream reads; the folder."""
    folder = scratch(docs.sparkSession, "arrivals")
    docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest(normalised(F.col("text")), digits).alias("digest"),
        F.input_file_name().alias("locator"),
    ).write.parquet(folder)
    return folder


def digest_state(spark, folder: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH):
    """Run the stream over all that has arrived; its state: digest, n, at, first_id, locator.

    Called again with the same checkpoint after more files arrived, it goes on where it ended.
    """
    # Without the second setting every store holds 4 MB of disk, however little is in it. The others bound
    # the memory beside the heap: a task's store is closed when it ends, and is written out every 4 MB.
    wanted = {_PROVIDER: _ROCKS, _ALLOCATE: "false", _UNLOAD: "true", _BUFFER: "4"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        stream = (
            spark.readStream.schema("doc_id long, digest string, locator string")
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder)
        )
        first = F.min(F.struct(order_key(F.col("doc_id")).alias("at"), "doc_id", "locator"))
        query = (
            stream.groupBy("digest")
            .agg(F.count("*").alias("n"), first.alias("first"))
            .writeStream.outputMode("update")
            .format("noop")
            .trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    state = spark.read.format("statestore").load(checkpoint)
    count, least = (f"value.`{f.name}`" for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col(count).alias("n"),
        F.col(f"{least}.at").alias("at"),
        F.col(f"{least}.doc_id").alias("first_id"),
        F.col(f"{least}.locator").alias("locator"),
    )


def check_hits(docs: DataFrame, state: DataFrame, digits: int) -> DataFrame:
    """Every document of a digest that was hit: is its text the one the locator names?"""
    norm = docs.select(
        order_key(F.col("doc_id").cast("long")).alias("at"),
        F.input_file_name().alias("file"),
        normalised(F.col("text")).alias("norm"),
    ).withColumn("digest", text_digest(F.col("norm"), digits))
    hits = state.filter("n > 1").select(
        "digest", F.col("at").alias("first_at"), F.col("locator")
    )
    members = saved(norm.join(hits, "digest"), "hits")
    named = saved(
        members.filter("at = first_at AND file = locator")
        .groupBy("digest")
        .agg(F.min("norm").alias("named")),
        "named",
    )  # written, so that the join below can split the members of a very large group
    return members.join(named, "digest").select(
        "digest", "at", "norm", (F.col("norm") == F.col("named")).alias("same")
    )


def exact_groups(docs: DataFrame, digits: int = 64, files_per_batch: int = FILES_PER_BATCH):
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    digits: hex digits of the SHA-256 that serve as digest; fewer only for tests.
    """
    spark = docs.sparkSession
    folder = arrive(docs, digits)
    arrived = spark.read.schema("doc_id long, digest string, locator string").parquet(folder)
    if arrived.isEmpty():
        return arrived.selectExpr(
            "doc_id", "doc_id AS keep_id", "1L AS group_size", "true AS kept", "digest"
        )
    state = saved(
        digest_state(spark, folder, scratch(spark, "digest-state"), files_per_batch), "digests"
    )
    rows = arrived.groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    checked = check_hits(docs, state, digits)
    odd = saved(checked.filter("NOT same").select("digest", "at", "norm"), "collisions")
    if odd.isEmpty():
        groups = rows.join(state.select("digest", "n", "first_id"), "digest")
    else:
        groups = _apart(rows, state, odd)
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row")
    keeps = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("row") == 1)
    return groups.select("doc_id", "digest", "n", "first_id", repeats).select(
        "doc_id",
        F.col("first_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        keeps.alias("kept"),
        "digest",
    )


def _apart(rows: DataFrame, state: DataFrame, odd: DataFrame) -> DataFrame:
    """Groups when some digests stand for several texts: each text is a group of its own.

    odd: the documents whose text is not the named one. A doc_id that repeats with different
    texts of one digest appears here once per text.
    """
    from_id = F.when(F.col("at") != F.lit(2**63 - 1), F.col("at"))
    other = odd.groupBy("digest", "norm", "at").agg(F.count("*").alias("rows"))
    sizes = other.groupBy("digest", "norm").agg(
        F.sum("rows").alias("n"), F.min("at").alias("first_at")
    )
    others = (
        other.join(sizes, ["digest", "norm"])
        .withColumn("doc_id", from_id)
        .withColumn("first_id", F.when(F.col("first_at") != F.lit(2**63 - 1), F.col("first_at")))
        .select("doc_id", "digest", "rows", "n", "first_id")
    )
    moved = other.groupBy("digest", "at").agg(F.sum("rows").alias("moved"))
    lost = moved.groupBy("digest").agg(F.sum("moved").alias("lost"))
    named = (
        rows.withColumn("at", order_key(F.col("doc_id")))
        .join(moved, ["digest", "at"], "left")
        .withColumn("rows", F.col("rows") - F.coalesce("moved", F.lit(0)))
        .filter("rows > 0")
        .join(state.select("digest", "n", "first_id"), "digest")
        .join(lost, "digest", "left")
        .withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0)))
    )
    return named.select("doc_id", "digest", "rows", "n", "first_id").unionByName(others)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents")).withColumnRenamed(
        "digest", "text_sha256"
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with their columns."""
    kept = exact_groups(docs, **options).filter("kept").select(
        order_key(F.col("doc_id")).alias("dedup_at"), F.col("digest").alias("dedup_digest")
    )
    digits = options.get("digits", 64)
    keyed = docs.withColumns(
        {
            "dedup_at": order_key(F.col("doc_id").cast("long")),
            "dedup_digest": text_digest(normalised(F.col("text")), digits),
        }
    )
    keys = ["dedup_at", "dedup_digest"]
    row = F.row_number().over(Window.partitionBy(*keys).orderBy("dedup_at"))
    return (
        keyed.join(kept, keys, "left_semi")
        .withColumn("dedup_row", row)
        .filter("dedup_row = 1")
        .select(*docs.columns)
    )


ORACLE = r"""
WITH texts AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM texts JOIN groups USING (text_sha256)
"""
