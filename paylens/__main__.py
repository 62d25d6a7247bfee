"""Run the job: ``python -m paylens --source DIR --lake DIR``, or this file with spark-submit."""

from __future__ import annotations

import argparse

from paylens.plans.pipeline import extract, load, transform
from paylens.schemas import SOURCES
from paylens.session import TARGET_PARTITION_BYTES, build_session, fit_partitions, size_of
from paylens.sources.catalog import DATABASE

STAGES = ("extract", "transform", "load")


def main(argv: list[str] | None = None) -> dict[str, dict[str, int | None]]:
    parser = argparse.ArgumentParser(prog="paylens", description=__doc__)
    parser.add_argument("--source", required=True, help="folder with the CSV files")
    parser.add_argument(
        "--lake", required=True, help="folder for Parquet, reachable by all executors"
    )
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES)
    parser.add_argument(
        "--input-gb",
        type=float,
        help="size of the sources, sets the shuffle partitions (default: that of their files)",
    )
    parser.add_argument(
        "--partition-mb",
        type=float,
        default=TARGET_PARTITION_BYTES / 2**20,
        help="input per shuffle partition",
    )
    parser.add_argument("--multi-line", action="store_true", help="CSV fields contain line breaks")
    parser.add_argument(
        "--fresh", action="store_true", help="write also what is complete for the present sources"
    )
    parser.add_argument("--append", action="store_true", help="add to the tables of the database")
    args = parser.parse_args(argv)

    per_partition = int(args.partition_mb * 2**20)
    spark = build_session(partition_bytes=per_partition)
    files = [f"{args.source}/{s.file}" for s in SOURCES.values()]
    size = int(args.input_gb * 1e9) if args.input_gb else size_of(spark, *files)
    if size:
        fit_partitions(spark, size, per_partition)

    def report_extract() -> dict[str, int | None]:
        done = extract(spark, args.source, args.lake, args.multi_line, args.fresh)
        for status, n in done.statuses.items():
            print(f"status {status}: {n}")
        for name, x in done.sources.items():
            if x:
                print(f"read {name}: {x.rows_read}, kept {x.rows_kept}")
        return done.rows

    stages = {
        "extract": report_extract,
        "transform": lambda: transform(spark, args.lake, args.fresh),
        "load": lambda: load(spark, args.lake, args.database, args.append, args.fresh),
    }
    done = {stage: stages[stage]() for stage in STAGES if stage in args.stages}
    for stage, rows in done.items():
        for name, n in rows.items():
            print(f"{stage} {name}: {'skipped' if n is None else n}")
    return done


if __name__ == "__main__":
    main()
