"""Table schemas.

Input tables keep the reference's all-string layout at the boundary; the
typed helpers add parsed columns next to the raw strings, never instead of
them (hours >= 24 are legal in ``action_time`` and do not parse as a time).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# One row per vehicle pass, all nullable strings, in file column order.
FLOW_COLUMNS = ["date", "monitor_id", "camera_id", "car", "action_time",
                "speed", "road_id", "area_id"]
FLOW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FLOW_COLUMNS])

# Camera registry: the cameras each monitor is expected to have.
REGISTRY_SCHEMA = T.StructType([
    T.StructField("monitor_id", T.StringType(), True),
    T.StructField("camera_id", T.StringType(), True),
])

# Area dimension.
AREA_SCHEMA = T.StructType([
    T.StructField("area_id", T.StringType(), True),
    T.StructField("area_name", T.StringType(), True),
])

# Job parameter table; only task_id and task_param are read.
TASK_SCHEMA = T.StructType([
    T.StructField("task_id", T.IntegerType(), False),
    T.StructField("task_name", T.StringType(), True),
    T.StructField("create_time", T.StringType(), True),
    T.StructField("start_time", T.StringType(), True),
    T.StructField("finish_time", T.StringType(), True),
    T.StructField("task_type", T.StringType(), True),
    T.StructField("task_status", T.StringType(), True),
    T.StructField("task_param", T.StringType(), True),
])

# Detail rows written by the detail result tables (no area_id).
DETAIL_COLUMNS = ["date", "monitor_id", "camera_id", "car", "action_time", "speed", "road_id"]

# An extra unique column that a source may add (the events adapter does); it
# ends the order of one car's passes.
TIEBREAK_COLUMN = "event_id"


def speed_kmh(col: str | Column = "speed") -> Column:
    """Speed text as INT; null when it is not an integer."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(T.IntegerType())
