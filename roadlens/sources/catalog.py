"""Pass tables in the session's catalog, laid out by plate and time slice.

A table is partitioned by ``date`` and bucketed by plate and slice of the
plate's time (the slices of ``operators.slices``). Rows of a slice lie in one
bucket, so tracks and paths are worked out where the rows are: their plans
have no exchange of passes, only of slice ends and counts. Buckets are dealt
by slice, not by plate alone, so a plate with a third of all passes is spread
over all of them. Date ranges prune partitions as in a plain table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators.slices import STORED_SLICE, slice_number
from roadlens.schema import FLOW_COLUMNS, FLOW_SCHEMA, REGISTRY_SCHEMA, TIEBREAK_COLUMN
from roadlens.sources.files import read_flow_catalog, read_tsv

BUCKETS = 64


def save_flow_catalog(flow: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Replace the catalog table ``table`` by the passes of ``flow``; returns it as read back.

    ``buckets`` sets how many tasks read a date range at once, and is fixed for
    the table: choose it for the largest range. ``path`` names the folder of an
    external table; without it the table lies in the warehouse.
    """
    kept = [c for c in (*FLOW_COLUMNS, TIEBREAK_COLUMN) if c in flow.columns]
    laid = flow.select(*kept).withColumn(STORED_SLICE, slice_number("action_time"))
    # dealt as the buckets are, so that each task writes its own buckets' files
    writer = (laid.repartition(buckets, "car", STORED_SLICE).write.mode("overwrite").format("parquet")
              .option("partitionOverwriteMode", "static").partitionBy("date").bucketBy(buckets, "car", STORED_SLICE).sortBy("car", STORED_SLICE))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return read_flow_catalog(flow.sparkSession, table)


def load_catalog(spark: SparkSession, flow_files: str, table: str, buckets: int = BUCKETS,
                 registry_files: str | None = None, registry_table: str | None = None) -> DataFrame:
    """Load tab-delimited pass files (and registry files) into catalog tables, which are replaced."""
    if registry_files is not None and registry_table is not None:
        read_tsv(spark, registry_files, REGISTRY_SCHEMA).write.mode("overwrite").format("parquet").saveAsTable(registry_table)
    return save_flow_catalog(read_tsv(spark, flow_files, FLOW_SCHEMA), table, buckets)
