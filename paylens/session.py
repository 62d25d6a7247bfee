"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
_work_dirs: dict[str, str] = {}


def partitions_for(input_bytes: int, partition_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Shuffle partitions of about ``partition_bytes`` for an input of this size, at any size."""
    return max(1, math.ceil(input_bytes / partition_bytes))


def size_of(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths that exist, from the file system's listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(conf)
        if files.exists(place):
            total += files.getContentSummary(place).getLength()
    return total


def fit_partitions(
    spark: SparkSession, input_bytes: int, partition_bytes: int = TARGET_PARTITION_BYTES
) -> None:
    """Set the shuffle partitions of a running session."""
    n = partitions_for(input_bytes, partition_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))


def settings(
    input_bytes: int | None = None, partition_bytes: int = TARGET_PARTITION_BYTES
) -> dict[str, str]:
    """Settings for a session of this package.

    Adaptive execution merges small shuffle partitions but makes no further ones for plain
    aggregations and sorts, so their number has to follow ``input_bytes``, the size of the
    sources. It only has to be roughly right, and can be set later (``fit_partitions``).
    ``partition_bytes`` is the input per partition; smaller for executors with little memory.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.ui.enabled": "false",
    }
    if input_bytes is not None:
        conf["spark.sql.shuffle.partitions"] = str(partitions_for(input_bytes, partition_bytes))
    return conf


def build_session(
    app: str = "paylens",
    master: str | None = None,
    input_bytes: int | None = None,
    partition_bytes: int = TARGET_PARTITION_BYTES,
    **conf: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(input_bytes, partition_bytes), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir`` (or the checkpoint folder).

    Only a local session without that setting falls back to a temporary folder: on a
    cluster such a folder is not visible to the other machines.
    """
    app_id = spark.sparkContext.applicationId
    if app_id not in _work_dirs:
        shared = (
            spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        )
        if shared:
            _work_dirs[app_id] = f"{shared.rstrip('/')}/paylens-{app_id}"
        elif spark.sparkContext.master.startswith("local"):
            _work_dirs[app_id] = tempfile.mkdtemp(prefix="paylens-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _work_dirs[app_id]
