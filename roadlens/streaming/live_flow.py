"""Live flow per monitor on Structured Streaming.

Pass count and speed per monitor per five-minute tumbling window of event
time. Windows are emitted once (append mode) when the watermark passes
their end; rows later than the watermark are dropped. State is bounded by
(watermark delay / window) x monitors.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadlens.functions.dates import lenient_seconds
from roadlens.schema import speed_kmh
from roadlens.sources.events import passes_from_events


def stream_monitor_speed(passes: DataFrame, watermark: str = "10 minutes",
                         window: str = "5 minutes") -> DataFrame:
    """Windowed flow: ``window_start``, ``window_end`` (timestamps), ``monitor_id``,
    ``passes``, ``speed_sum``, ``avg_speed``.

    ``passes`` may be a streaming or a batch DataFrame of pass rows. Event
    time is the pass time text read leniently as a UTC wall clock (hour 25
    is 01:00 of the next day), so windows do not depend on the session time
    zone; rows whose time does not parse are dropped.
    """
    timed = (passes.withColumn("event_ts", F.timestamp_seconds(lenient_seconds("action_time")))
             .filter(F.col("event_ts").isNotNull())
             .withColumn("_speed", speed_kmh("speed")))
    agg = (timed.withWatermark("event_ts", watermark)
           .groupBy(F.window("event_ts", window).alias("_w"), "monitor_id")
           .agg(F.count(F.lit(1)).alias("passes"),
                F.sum("_speed").cast(T.LongType()).alias("speed_sum"),
                F.count("_speed").alias("_speed_n")))
    return agg.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "monitor_id",
        "passes", "speed_sum",
        # null, not an error, when no pass of the window has a numeric speed
        F.try_divide(F.col("speed_sum").cast(T.DoubleType()), F.col("_speed_n").cast(T.DoubleType())).alias("avg_speed"))


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over events parquet.

    ``path`` is a folder whose parquet files are picked up as they arrive,
    or one file (its folder is watched for files of that name). The schema
    is read from the files present at start.
    """
    reader_opts = {}
    directory = path
    files = spark.read.parquet(path).inputFiles()  # in whatever store: Spark lists it
    if len(files) == 1 and os.path.basename(unquote(files[0])) == os.path.basename(path):
        directory, reader_opts["pathGlobFilter"] = os.path.split(path)
    batch = spark.read
    for key, value in reader_opts.items():
        batch = batch.option(key, value)
    reader = spark.readStream.schema(batch.parquet(directory).schema)
    for key, value in reader_opts.items():
        reader = reader.option(key, value)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(directory)


def start_to_files(result: DataFrame, out_path: str, checkpoint_path: str,
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append the windowed rows to parquet files, with a checkpoint for recovery.

    The file sink and the checkpoint make the output exactly-once across
    restarts. ``available_now`` processes what is there and stops.
    """
    writer = (result.writeStream.outputMode("append").format("parquet")
              .option("path", out_path).option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows the watermark dropped as too late, over the query's recent progress."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for progress in query.recentProgress for op in progress.get("stateOperators", []))


def run_events_flow(spark: SparkSession, events_path: str, out_path: str, checkpoint_path: str,
                    watermark: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Run the live flow once over the events files and read back its output."""
    stream = passes_from_events(events_stream(spark, events_path))
    query = start_to_files(stream_monitor_speed(stream, watermark, window), out_path, checkpoint_path)
    query.awaitTermination()
    return spark.read.parquet(out_path)
