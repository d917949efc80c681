"""``python -m voltlake load|export``, or the same file through spark-submit."""

import argparse

from pyspark.sql import SparkSession

from voltlake import export_job, load_job
from voltlake.operators import MAX_TASK_ROWS
from voltlake.schema import N_BATTERIES


def main() -> None:
    parser = argparse.ArgumentParser(prog="voltlake")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="append CSV files to the readings table")
    load.add_argument("csv")
    load.add_argument("table")
    load.add_argument("--batteries", type=int, default=N_BATTERIES)
    load.add_argument("--zone", help="zone of timestamps without an offset")
    export = commands.add_parser("export", help="export the readings table to Parquet")
    export.add_argument("table")
    export.add_argument("out")
    export.add_argument("--group", choices=["count", "bucket"], required=True)
    export.add_argument("--size", type=int, required=True, help="records, or seconds, per group")
    export.add_argument("--as-of", help="cut-off of a bucket export, by default now")
    export.add_argument("--codec", default="snappy")
    export.add_argument("--narrow", action="store_true", help="apply the tighter types")
    export.add_argument("--quarantine", help="path for rows that break the tighter types")
    export.add_argument("--max-files", type=int, help="refuse an export of more files")
    export.add_argument("--rows-per-file", type=int, default=MAX_TASK_ROWS)
    export.add_argument("--batteries", type=int, default=N_BATTERIES)
    export.add_argument("--contents", action="store_true", help="read the written values back and compare")
    export.add_argument("--log", help="path of the run log")
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"voltlake-{args.command}").getOrCreate()
    if args.command == "load":
        print("rows in table:", load_job(spark, args.csv, args.table, args.zone, args.batteries))
    else:
        result = export_job(
            spark, args.table, args.out, args.group, args.size, args.as_of,
            args.codec, args.narrow, args.quarantine, args.log,
            args.max_files, args.rows_per_file, args.batteries, args.contents,
        )
        print(
            f"rows: {result.n_rows}, groups: {result.n_groups}, files: {result.n_files}, "
            f"milliseconds: {result.elapsed_ms}"
        )
    spark.stop()


if __name__ == "__main__":
    main()
