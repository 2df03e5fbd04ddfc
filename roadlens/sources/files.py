"""Tab-delimited pass files and the date-partitioned parquet table.

The load step reads the text files with the fixed schema (no inference),
keeps quotes as ordinary characters as a delimited text table would, and
writes parquet partitioned by ``date`` so that date ranges prune whole
partitions. A load replaces the whole table. As in a delimited text table,
``\\N`` is null and an empty field is an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators.slices import STORED_SLICE
from roadlens.schema import FLOW_COLUMNS, FLOW_SCHEMA, REGISTRY_SCHEMA, TIEBREAK_COLUMN

_TEXT_OPTIONS = {"sep": "\t", "quote": "", "escape": "", "header": "false",
                 "mode": "PERMISSIVE", "emptyValue": "", "nullValue": "\\N"}


def _reader(spark: SparkSession, schema):
    return spark.read.schema(schema).options(**_TEXT_OPTIONS)


def read_tsv(spark: SparkSession, path: str, schema=FLOW_SCHEMA) -> DataFrame:
    """Rows of tab-delimited files with a fixed all-string schema."""
    return _reader(spark, schema).csv(path)


def write_tsv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write rows as tab-delimited text (no header, no quoting)."""
    cols = columns or FLOW_COLUMNS
    (df.select(*cols).write.mode("overwrite")
       .option("sep", "\t").option("quote", "").option("escape", "")
       .option("header", "false").option("nullValue", "\\N").option("emptyValue", "").csv(path))


def load_tsv(spark: SparkSession, flow_path: str, table_path: str,
             registry_path: str | None = None, registry_table_path: str | None = None) -> DataFrame:
    """Load pass files into a parquet table partitioned by ``date``.

    Returns the loaded table read back with the fixed schema (``date`` stays
    a string). The optional registry files are loaded to their own table.
    """
    flow = read_tsv(spark, flow_path, FLOW_SCHEMA)
    # rows of a date meet in few tasks (AQE splits a large date), so files follow
    # the dates and not tasks x dates
    (flow.hint("rebalance", "date").write.mode("overwrite")
         .option("partitionOverwriteMode", "static")
         .partitionBy("date").parquet(table_path))
    if registry_path is not None and registry_table_path is not None:
        read_tsv(spark, registry_path, REGISTRY_SCHEMA).write.mode("overwrite").parquet(registry_table_path)
    return read_flow_table(spark, table_path)


def read_flow_table(spark: SparkSession, table_path: str) -> DataFrame:
    """Read the partitioned pass table with the declared schema.

    Passing the schema keeps the ``date`` partition column a string (type
    inference would turn it into DATE); a ``between`` on it prunes partitions.
    """
    return spark.read.schema(FLOW_SCHEMA).parquet(table_path).select(*FLOW_COLUMNS)


def read_flow_catalog(spark: SparkSession, table: str = "monitor_flow_action") -> DataFrame:
    """Passes from a catalog table or view (e.g. ``traffic.monitor_flow_action``), with its layout if it has one."""
    passes = spark.table(table)
    layout = [c for c in (TIEBREAK_COLUMN, STORED_SLICE) if c in passes.columns] if STORED_SLICE in passes.columns else []
    return passes.select(*FLOW_COLUMNS, *layout)
