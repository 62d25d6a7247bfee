"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
AT_ONCE = 4


def together(
    spark: SparkSession, work: Mapping[str, Callable[[], T]], at_once: int = AT_ONCE
) -> dict[str, T]:
    """Run independent jobs, ``at_once`` at a time, so that one job's last tasks do not leave
    the cluster idle. Results are in the order of ``work``; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in work.items()
        }
        return {name: job.result() for name, job in running.items()}
