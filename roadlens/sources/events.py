"""Adapter from the generic ``events`` table to vehicle passes.

Each event is one pass: the user is the car, ``props.k`` picks the camera
(and its monitor), the event type is the road and the value the speed. The
date range is applied to the raw ``ts`` column first so that it reaches the
parquet scan as a pushed filter; the string ``date`` is derived afterwards.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadlens.functions.text import pad_id

# Fixed adapter values: 9 monitors, 5-digit cameras, 4-digit monitors,
# 'U' + 5-digit plates, 5 areas with 2-digit ids.
N_MONITORS = 9
N_AREAS = 5
MONITOR_WIDTH = 4
CAMERA_WIDTH = 5
CAR_WIDTH = 5
AREA_WIDTH = 2
CAR_PREFIX = "U"


def _next_day(text: str) -> str:
    return (_dt.date.fromisoformat(text) + _dt.timedelta(days=1)).isoformat()


def _wall_clock(text: str):
    # a string cast to TIMESTAMP_NTZ is the same instant in every session time zone
    return F.lit(text).cast(T.TimestampNTZType())


def passes_from_events(events: DataFrame, start_date: str | None = None,
                       end_date: str | None = None) -> DataFrame:
    """Pass rows (the eight flow columns plus ``event_id``) from events.

    ``start_date``/``end_date`` are inclusive ``yyyy-MM-dd`` bounds. Times are
    wall-clock text of the ``TIMESTAMP_NTZ`` value, independent of the
    session time zone.
    """
    ev = events
    ts = F.col("ts").cast(T.TimestampNTZType())
    if start_date is not None:
        ev = ev.filter(ts >= _wall_clock(start_date))
    if end_date is not None:
        ev = ev.filter(ts < _wall_clock(_next_day(end_date)))
    k = F.from_json("props", "k INT").getField("k")
    clock = F.substring(ts.cast("string"), 1, 19)  # yyyy-MM-dd HH:mm:ss
    return ev.select(
        F.substring(clock, 1, 10).alias("date"),
        pad_id((k % N_MONITORS).cast("string"), MONITOR_WIDTH).alias("monitor_id"),
        pad_id(k.cast("string"), CAMERA_WIDTH).alias("camera_id"),
        F.concat(F.lit(CAR_PREFIX), pad_id(F.col("user_id").cast("string"), CAR_WIDTH)).alias("car"),
        clock.alias("action_time"),
        F.floor("value").try_cast(T.IntegerType()).cast("string").alias("speed"),
        F.col("event_type").alias("road_id"),
        pad_id((F.col("user_id") % N_AREAS).cast("string"), AREA_WIDTH).alias("area_id"),
        F.col("event_id"),
    )


def read_passes(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                end_date: str | None = None) -> DataFrame:
    """Passes from ``{sf_dir}/events.parquet``."""
    return passes_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), start_date, end_date)


def area_from_region(region: DataFrame) -> DataFrame:
    """Area dimension (``area_id``, ``area_name``) from the region table."""
    return region.select(
        pad_id(F.col("r_regionkey").cast("string"), AREA_WIDTH).alias("area_id"),
        F.col("r_name").alias("area_name"),
    )
