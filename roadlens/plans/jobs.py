"""Command-line entry points for ``spark-submit``.

::

    spark-submit roadlens/plans/jobs.py load --files IN_DIR --table FLOW_TABLE [--catalog [--buckets 64]]
    spark-submit roadlens/plans/jobs.py run-task --task-id 5 --table FLOW_TABLE \\
        --tasks tasks.jsonl --out RESULT_DIR [--out-jdbc URL] [--registry REGISTRY_TABLE] [--areas AREAS_TABLE]

Tables are folders or, with ``--catalog``, names of catalog tables (``load``
lays them out by plate and time slice). The task table comes from JSON lines (``task_id``, ``task_param``, ...) or,
with ``--tasks-jdbc-url`` and ``--tasks-jdbc-table``, from a database. The
camera registry defaults to the cameras seen in the whole pass table.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.monitor import camera_registry
from roadlens.plans.tasks import run_task
from roadlens.schema import AREA_SCHEMA, REGISTRY_SCHEMA, TASK_SCHEMA
from roadlens.sources.catalog import BUCKETS, load_catalog, read_flow_catalog
from roadlens.sources.files import load_tsv, read_flow_table


def _tasks(spark: SparkSession, args) -> DataFrame:
    if args.tasks_jdbc_url:
        return (spark.read.jdbc(args.tasks_jdbc_url, args.tasks_jdbc_table)
                .select(F.col("task_id").cast("int"), F.col("task_param").cast("string")))
    return spark.read.schema(TASK_SCHEMA).json(args.tasks).select("task_id", "task_param")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="roadlens")
    sub = p.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="load tab-delimited pass files into a date-partitioned table")
    load.add_argument("--files", required=True)
    load.add_argument("--table", required=True)
    load.add_argument("--registry-files")
    load.add_argument("--registry-table")
    load.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a catalog table")
    run = sub.add_parser("run-task", help="run one stored task and write its result tables")
    run.add_argument("--task-id", type=int, required=True)
    run.add_argument("--table", required=True, help="pass table written by 'load'")
    run.add_argument("--out", help="folder of the result tables")
    run.add_argument("--out-jdbc", help="URL of a database that has the result tables")
    run.add_argument("--tasks", help="task rows as JSON lines")
    run.add_argument("--tasks-jdbc-url")
    run.add_argument("--tasks-jdbc-table", default="task")
    run.add_argument("--registry", help="parquet registry table (monitor_id, camera_id)")
    run.add_argument("--areas", help="parquet area table (area_id, area_name)")
    for command in (load, run):
        command.add_argument("--catalog", action="store_true", help="tables are names of catalog tables")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("roadlens").getOrCreate()
    if args.command == "load" and args.catalog:
        load_catalog(spark, args.files, args.table, args.buckets, args.registry_files, args.registry_table)
        return [args.table]
    if args.command == "load":
        load_tsv(spark, args.files, args.table, args.registry_files, args.registry_table)
        return [args.table]
    if not args.tasks and not args.tasks_jdbc_url:
        raise SystemExit("run-task needs --tasks or --tasks-jdbc-url")
    if not args.out and not args.out_jdbc:
        raise SystemExit("run-task needs --out or --out-jdbc")

    def table(name: str, schema) -> DataFrame:
        return spark.table(name).select(*schema.names) if args.catalog else spark.read.schema(schema).parquet(name)

    flow = read_flow_catalog(spark, args.table) if args.catalog else read_flow_table(spark, args.table)
    registry = table(args.registry, REGISTRY_SCHEMA) if args.registry else camera_registry(flow)
    areas = table(args.areas, AREA_SCHEMA) if args.areas else spark.createDataFrame([], AREA_SCHEMA)
    return run_task(spark, _tasks(spark, args), args.task_id, flow, registry, areas, args.out, args.out_jdbc)


def cli() -> int:
    """Console entry point: run, print the written tables, exit 0."""
    print(main(sys.argv[1:]))
    return 0


if __name__ == "__main__":
    sys.exit(cli())
