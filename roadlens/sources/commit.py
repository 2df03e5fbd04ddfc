"""One commit for all result tables of a task.

A task's tables are first written to a folder of their own, the attempt. Only
when all of them are there, one row is appended to the manifest ``task_commits``:
the task, the attempt, its version and its tables. That row is one file, which
the file system shows whole or not at all, so readers of the manifest
(:func:`read_committed`) see either all tables of an attempt or those of the
attempt before it. A failed task adds no row and changes nothing; a rerun is a
new version, and rows never double.

:func:`publish` copies a committed attempt into the plain layout (a folder per
table, partitioned by task, replaced as a partition) for readers that know no
manifest. A copy that breaks off is repeated by :func:`recover` from the
manifest, which serves as its redo log. Of two runs of one task at the same
time, the later version counts, then the larger attempt id.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from roadlens.session import remove_path
from roadlens.sources.sink import write_result

_MANIFEST = "task_id string, version long, attempt string, tables array<string>, task_columns array<string>"
_PUBLISHED = "task_id string, version long"


def _log(spark: SparkSession, out_dir: str, name: str, schema: str) -> DataFrame:
    """Rows of a manifest; none if it was never written."""
    path = os.path.join(out_dir, name)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _append(spark: SparkSession, out_dir: str, name: str, schema: str, row: tuple) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(os.path.join(out_dir, name))


def _attempt_path(out_dir: str, task_id: str, attempt: str, table: str = "") -> str:
    return os.path.join(out_dir, "task_attempts", f"task_id={task_id}", attempt, table)


def committed(spark: SparkSession, out_dir: str) -> DataFrame:
    """The last committed attempt of each task: ``task_id, version, attempt, tables, task_columns``."""
    last = F.max(F.struct("version", "attempt", "tables", "task_columns")).alias("last")
    return _log(spark, out_dir, "task_commits", _MANIFEST).groupBy("task_id").agg(last).select("task_id", "last.*")


def commit_results(spark: SparkSession, results: dict[str, DataFrame], out_dir: str, task_id: int | str,
                   task_columns: dict[str, str] | None = None) -> int:
    """Write all ``results`` and then commit them as the task's next version, which is returned.

    Each table gets the task's id as a column, ``task_id`` or as ``task_columns`` names it.
    """
    task, attempt = str(task_id), uuid.uuid4().hex
    columns = {name: (task_columns or {}).get(name, "task_id") for name in results}
    for name, df in results.items():
        df.withColumn(columns[name], F.lit(task)).write.mode("errorifexists").parquet(_attempt_path(out_dir, task, attempt, name))
    rows = committed(spark, out_dir).filter(F.col("task_id") == task).select("version").take(1)
    version = 1 + (rows[0]["version"] if rows else 0)
    _append(spark, out_dir, "task_commits", _MANIFEST, (task, version, attempt, [*columns], [*columns.values()]))
    return version


def read_committed(spark: SparkSession, out_dir: str, table: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of ``table`` of every task's last committed attempt.

    ``schema`` (with the task column) is needed only to read a table that no task has written.
    """
    # one row a task
    paths = [_attempt_path(out_dir, r["task_id"], r["attempt"], table)
             for r in committed(spark, out_dir).filter(F.array_contains("tables", table)).collect()]
    reader = spark.read if schema is None else spark.read.schema(schema)
    if not paths:
        if schema is None:
            raise ValueError(f"no task has committed {table}")
        return spark.createDataFrame([], schema)
    return reader.parquet(*paths)


def publish(spark: SparkSession, out_dir: str, task_id: int | str) -> bool:
    """Copy the task's last committed attempt into the plain tables; false if there is none."""
    rows = committed(spark, out_dir).filter(F.col("task_id") == str(task_id)).collect()
    for r in rows:
        for table, column in zip(r["tables"], r["task_columns"]):
            staged = spark.read.parquet(_attempt_path(out_dir, r["task_id"], r["attempt"], table)).drop(column)
            path = os.path.join(out_dir, table)
            if staged.isEmpty():  # an overwrite by nothing would leave the rows of an earlier run
                remove_path(spark, os.path.join(path, f"{column}={r['task_id']}"))
            else:
                write_result(staged, path, r["task_id"], task_column=column)
        _append(spark, out_dir, "task_published", _PUBLISHED, (r["task_id"], r["version"]))
    return bool(rows)


def recover(spark: SparkSession, out_dir: str) -> list[str]:
    """Publish every committed attempt that is not yet published; returns the tasks."""
    done = (_log(spark, out_dir, "task_published", _PUBLISHED).groupBy("task_id")
            .agg(F.max("version").alias("published")))
    late = committed(spark, out_dir).join(done, "task_id", "left").filter(
        F.col("version") > F.coalesce("published", F.lit(0))).select("task_id")
    tasks = sorted(r["task_id"] for r in late.collect())
    for task in tasks:
        publish(spark, out_dir, task)
    return tasks


def drop_superseded(spark: SparkSession, out_dir: str) -> list[str]:
    """Remove the attempts that a later version of their task has replaced; returns them.

    Call it when no reader is on an old version. Attempts that were never
    committed are left: their task may still be running.
    """
    log = _log(spark, out_dir, "task_commits", _MANIFEST)
    kept = committed(spark, out_dir).select("task_id", "attempt")
    old = log.join(kept, ["task_id", "attempt"], "left_anti").select("task_id", "attempt").distinct().collect()
    return [r["attempt"] for r in old if remove_path(spark, _attempt_path(out_dir, r["task_id"], r["attempt"]))]
