from __future__ import annotations

from types import SimpleNamespace

import pytest

from paylens.session import partitions_for, settings, size_of, work_dir


def test_work_dir_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark) == f"{shared}/paylens-{spark.sparkContext.applicationId}"


def session(master, app, folder=None):
    context = SimpleNamespace(applicationId=app, master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf={}, sparkContext=context)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session("spark://host:7077", "app-1"))
    assert work_dir(session("spark://host:7077", "app-2", "hdfs:/c")) == "hdfs:/c/paylens-app-2"
    assert "paylens-" in work_dir(session("local[2]", "app-3"))


def test_partitions_follow_the_input_at_any_size():
    assert "spark.sql.shuffle.partitions" not in settings()
    assert [partitions_for(n) for n in (0, 1, 10 * 1024**3)] == [1, 1, 80]
    assert settings(10 * 1024**4)["spark.sql.shuffle.partitions"] == "81920"
    assert settings(100 * 1024**4)["spark.sql.shuffle.partitions"] == "819200"
    small = settings(100 * 1024**4, partition_bytes=64 * 1024**2)
    assert small["spark.sql.shuffle.partitions"] == "1638400"
    assert small["spark.sql.files.maxPartitionBytes"] == str(64 * 1024**2)


def test_size_of_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_bytes(b"x" * 1000)
    (tmp_path / "y.csv").write_bytes(b"y" * 500)
    paths = [str(tmp_path / "a"), str(tmp_path / "y.csv"), str(tmp_path / "none")]
    assert size_of(spark, *paths) == 1500
