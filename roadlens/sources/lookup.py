"""Tables in which a few plates are found without reading the rest.

Passes of a date lie in files sorted by plate, in small row groups with a
Bloom filter of their plates. A look-up by plate skips the row groups whose
smallest and largest plate exclude it, and those whose filter does not know
it; only the others are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.common import legal_cars
from roadlens.schema import FLOW_COLUMNS, TIEBREAK_COLUMN

ROW_GROUP_BYTES = 8 << 20


def save_lookup_table(flow: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES,
                      cars_per_group: int = 50_000) -> None:
    """Replace the table at ``path``, partitioned by date; tasks hold ranges of (date, plate)."""
    kept = [c for c in (*FLOW_COLUMNS, TIEBREAK_COLUMN) if c in flow.columns]
    (flow.select(*kept).repartitionByRange("date", "car", "action_time").sortWithinPartitions("date", "car", "action_time")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.bloom.filter.enabled#car", "true")
     .option("parquet.bloom.filter.expected.ndv#car", cars_per_group)
     .parquet(path))


def find_cars(spark: SparkSession, path: str, cars: list[str], start_date: str | None = None,
              end_date: str | None = None) -> DataFrame:
    """All passes of ``cars`` in the inclusive date range, read by row groups that may hold them."""
    from roadlens.sources.files import read_flow_table
    passes = legal_cars(read_flow_table(spark, path))
    if start_date is not None:
        passes = passes.filter(F.col("date") >= start_date)
    if end_date is not None:
        passes = passes.filter(F.col("date") <= end_date)
    # one equality a plate: a list as such would reach the files only as a range of plates
    wanted = [F.col("car") == car for car in dict.fromkeys(cars)]
    return passes.filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))
