"""Live pass feeds.

Passes arrive as tab-delimited text lines in the eight flow columns (the
same layout as the load files). ``parse_pass_lines`` turns a ``value``
column into pass rows; the Kafka reader needs the Spark Kafka connector on
the classpath (supplied by the deployment) and otherwise fails when the
query starts, not at import.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.schema import FLOW_COLUMNS


def parse_pass_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Tab-delimited text lines to the eight flow columns (missing fields are null)."""
    parts = F.split(F.col(value_col).cast("string"), "\t")
    return lines.select(*[F.get(parts, i).alias(name) for i, name in enumerate(FLOW_COLUMNS)])


def text_pass_stream(spark: SparkSession, directory: str) -> DataFrame:
    """Stream of passes from text files dropped into ``directory``."""
    return parse_pass_lines(spark.readStream.format("text").load(directory))


def kafka_pass_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                      starting_offsets: str = "latest") -> DataFrame:
    """Stream of passes from a Kafka topic whose messages are pass lines."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .load())
    return parse_pass_lines(raw.select(F.col("value").cast("string").alias("value")))
