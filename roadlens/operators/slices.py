"""A car's passes cut into time slices, so that no task holds a whole car.

Passes of a car that share time, time text and monitor follow each other in
the car's order (time, text, monitor, camera, unique id), so they count as one
run. Runs are counted before they are shuffled, and gathered per (car, slice):
a slice is ``SLICE_SECONDS`` of the car's time, or, for passes whose time does
not parse, one text. What a slice holds is thus bounded by its seconds and the
monitors, however many passes a plate has and even if all its times are bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadlens.functions.dates import lenient_seconds
from roadlens.operators.common import legal_cars
from roadlens.schema import TIEBREAK_COLUMN

SLICE_SECONDS = 600

# Passes whose time does not parse come first, before every valid time.
_NO_TIME = -(2 ** 62)

#: Column of a table that is laid out by slices: the slice's number, for ``SLICE_SECONDS``.
STORED_SLICE = "track_slice"

#: Identity of a slice, and the order of a car's slices.
SLICE_KEY = ["car", "slice", "slice_text"]
SLICE_ORDER = ["slice", "slice_text"]


def slice_number(time_text: str, seconds: int = SLICE_SECONDS) -> Column:
    """Which slice of its car's time a pass belongs to."""
    return F.coalesce(F.floor(lenient_seconds(time_text) / seconds), F.lit(_NO_TIME).cast(T.LongType()))


def track_slices(flow: DataFrame, label: Column | None = None, last_date: bool = False,
                 seconds: int = SLICE_SECONDS) -> DataFrame:
    """``car, slice, slice_text`` and ``runs``: the slice's runs in the car's order.

    A flow from a table laid out by slices is not shuffled: its slices are read
    from ``STORED_SLICE``. A run has ``label`` (default: the monitor; any function of it) and ``n``
    passes; with ``last_date`` also ``last``, whose ``date`` is its last pass's.
    """
    same = ["car", "slice", "slice_text", "t", "action_time", "monitor_id"]
    columns = dict.fromkeys([*same[4:], "car", *(["camera_id", "date", TIEBREAK_COLUMN] if last_date else [])])
    stored = STORED_SLICE in flow.columns and seconds == SLICE_SECONDS
    number = F.col(STORED_SLICE) if stored else slice_number("action_time", seconds)
    passes = legal_cars(flow).select(*[c for c in columns if c in flow.columns], number.alias("slice"),
                                     lenient_seconds("action_time").alias("t"))
    passes = passes.withColumn("slice_text", F.when(F.col("t").isNull(), F.col("action_time")))
    values = [F.count(F.lit(1)).alias("n")]
    if last_date:
        order = [c for c in ("camera_id", TIEBREAK_COLUMN) if c in flow.columns]
        values.append(F.max(F.struct(*order, "date")).alias("last"))
    runs = passes.groupBy(*same).agg(*values)
    label = F.col("monitor_id") if label is None else label
    run = F.struct("t", "action_time", "monitor_id", label.alias("label"), "n", *(["last"] if last_date else []))
    return runs.groupBy(*SLICE_KEY).agg(F.sort_array(F.collect_list(run)).alias("runs"))
