"""Time the headline queries and print one JSON line.

``build_*`` entries are the one-off work: the order fact and other tables written from
the supplied data. ``job_load_report`` is one run of the whole job, from writing the
sources as CSV to the published tables, and ``job_load_report_warm`` a second one. Every other
entry is one registered query, rows materialised without output: one warm-up run, then the median
of BENCH_RUNS runs (default 3). Intermediate tables go to BENCH_WORK_DIR (default: a new temporary
folder), set as ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import (  # noqa: E402
    numbered_payments,
    registered,
    report_tables,
    warehouse,
)
from paylens.plans.tables import SHARED  # noqa: E402
from paylens.schemas import TABLES  # noqa: E402
from paylens.session import build_session  # noqa: E402


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="paylens-bench-")
    spark = build_session(
        "paylens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": work,
            "spark.sql.warehouse.dir": f"{work}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    seconds["build_numbered_payments"] = timed(lambda: numbered_payments(spark, sf_dir))
    built = warehouse(spark, sf_dir)
    tables = report_tables(spark, sf_dir)
    for name in TABLES:
        seconds[f"build_{name}"] = timed(lambda name=name: built.table(name))
    for name in SHARED:
        seconds[f"build_{name}"] = timed(lambda name=name: getattr(tables, name))

    for name, query in sorted(registered().items()):
        if name.startswith("job_") and name != "job_load_report":
            continue  # they read what a job has written
        if name.startswith("publish_") and name.endswith("_normalized"):
            continue  # timed as build_*
        if name == "job_load_report":
            for label in (name, f"{name}_warm"):
                seconds[label] = timed(lambda query=query: run(query(spark, sf_dir)))
            continue
        run(query(spark, sf_dir))
        seconds[name] = statistics.median(
            timed(lambda: run(query(spark, sf_dir))) for _ in range(runs)
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
