"""Live top-N monitors, exactly once.

Each micro-batch adds its counts to the counts so far and writes them as a new
version; then one row of a ledger names the version. A batch that runs again
after its row is there (a restart, a retried trigger) changes nothing; one
that broke off before its row is worked out anew from the last version that
the ledger names. So every pass counts once, whatever fails in between, and
readers see whole versions only.

The counts grow with days and monitors, not with passes. The ledger belongs to
one streaming checkpoint: a query that starts over without its checkpoint
needs a new folder.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.session import remove_path

_LEDGER = "batch_id long"
_COUNTS = "date string, monitor_id string, car_count long"


class LiveCounts:
    """Versions of the passes per (date, monitor) below ``out_dir``."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir

    def _version(self, batch_id: int) -> str:
        return os.path.join(self.out_dir, "counts", f"batch={batch_id}")

    def last_batch(self) -> int | None:
        """The last batch in the ledger."""
        try:
            ledger = self.spark.read.schema(_LEDGER).parquet(os.path.join(self.out_dir, "ledger"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return ledger.agg(F.max("batch_id")).first()[0]

    def counts(self) -> DataFrame:
        """``date, monitor_id, car_count`` of the last version."""
        last = self.last_batch()
        if last is None:
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(self._version(last))

    def add(self, passes: DataFrame, batch_id: int) -> bool:
        """Count a micro-batch; false if the ledger has it already."""
        last = self.last_batch()
        if last is not None and batch_id <= last:
            return False
        new = (passes.filter(F.col("monitor_id").isNotNull() & F.col("date").isNotNull())
               .groupBy("date", "monitor_id").agg(F.count(F.lit(1)).alias("car_count")))
        (self.counts().unionByName(new).groupBy("date", "monitor_id").agg(F.sum("car_count").alias("car_count"))
         .write.mode("overwrite").parquet(self._version(batch_id)))  # an earlier try of this batch may have left files
        (self.spark.createDataFrame([(batch_id,)], _LEDGER).coalesce(1)
         .write.mode("append").parquet(os.path.join(self.out_dir, "ledger")))
        if last is not None:  # readers may still be on the version before
            remove_path(self.spark, self._version(last - 1))
        return True

    def top(self, n: int) -> DataFrame:
        """``date, rank, monitor_id, car_count``: each day's ``n`` busiest monitors so far (ties by monitor)."""
        busiest = Window.partitionBy("date").orderBy(F.desc("car_count"), "monitor_id")
        return (self.counts().withColumn("rank", F.row_number().over(busiest)).filter(F.col("rank") <= n)
                .select("date", "rank", "monitor_id", "car_count"))


def start_live_counts(passes: DataFrame, out_dir: str, checkpoint_path: str, available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Keep the counts of a stream of passes below ``out_dir``."""
    live = LiveCounts(passes.sparkSession, out_dir)
    writer = (passes.writeStream.option("checkpointLocation", checkpoint_path)
              .foreachBatch(lambda batch, batch_id: live.add(batch, batch_id)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
