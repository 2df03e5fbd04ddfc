"""Result writer.

Every result table is written by one call after the transformation (never
from inside a task), partitioned by ``task_id`` with dynamic partition
overwrite: re-running a task replaces its partition and never duplicates
rows, so a retried job is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_result(df: DataFrame, path: str, task_id: int | str, fmt: str = "parquet",
                 task_column: str = "task_id") -> None:
    """Write ``df`` as the rows of ``task_id`` under ``path``."""
    out = df.withColumn(task_column, F.lit(str(task_id)))
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(task_column)
        .format(fmt)
        .save(path))


def write_jdbc(df: DataFrame, url: str, table: str, task_id: int | str,
               properties: dict | None = None, num_partitions: int = 8, task_column: str = "task_id") -> None:
    """Append the rows of ``task_id`` to a JDBC table (bounded connections).

    The database keeps what it has: delete the task's rows before a rerun.
    """
    (df.withColumn(task_column, F.lit(str(task_id)))
       .repartition(num_partitions)  # unlike coalesce, leaves the stage before it its tasks
       .write.jdbc(url, table, mode="append", properties=properties or {}))


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a result table back; ``task_id`` stays a string (no type inference)."""
    full = T.StructType(list(schema.fields) + [T.StructField("task_id", T.StringType(), True)])
    return spark.read.schema(full).parquet(path)
