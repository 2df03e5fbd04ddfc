"""Flow by several groupings in one read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.dates import date_hour
from roadlens.schema import speed_kmh

#: The groupings of the stored reports: by monitor, by road in an area, by hour, by monitor and hour, all.
GROUPINGS = [["monitor_id"], ["area_id", "road_id"], ["date_hour"], ["monitor_id", "date_hour"], ["area_id"], []]
DIMENSIONS = ["area_id", "road_id", "monitor_id", "date_hour"]


def flow_groupings(flow: DataFrame, groupings: list[list[str]] | None = None) -> DataFrame:
    """``area_id, road_id, monitor_id, date_hour, grouping`` with passes, speed bands and the fastest speed.

    One scan and one shuffle for all groupings: a pass is counted towards each
    within its task, and only groups are shuffled. A dimension that a row is
    not grouped by is null; ``grouping`` (one bit a dimension, 0: grouped by it,
    the first dimension highest) tells it from a dimension that is null itself.
    """
    speed = speed_kmh("speed")
    passes = flow.select("area_id", "road_id", "monitor_id", date_hour("action_time").alias("date_hour"), speed.alias("kmh"))
    sets = [[F.col(c) for c in keys] for keys in (GROUPINGS if groupings is None else groupings)]
    s = F.col("kmh")
    return passes.groupingSets(sets, *DIMENSIONS).agg(
        F.grouping_id(*DIMENSIONS).cast("int").alias("grouping"), F.count(F.lit(1)).alias("passes"),
        F.count_if(s >= 120).alias("high_count"), F.count_if((s >= 90) & (s < 120)).alias("medium_count"),
        F.count_if((s >= 60) & (s < 90)).alias("normal_count"), F.count_if(s < 60).alias("low_count"),
        F.max("kmh").alias("max_speed"))
