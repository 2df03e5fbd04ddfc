"""Cars seen together with target cars (same monitor, same five-minute range)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.dates import cell_label, range_cell
from roadlens.operators.common import legal_cars

_CELL = ["monitor_id", "day", "hour", "start_min"]


def follow_car(flow: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """One row per (monitor, five-minute range) where a target car passed.

    ``targets`` is a list of plates or a DataFrame with a ``car`` column.
    ``monitor_id``, ``range_time``, ``cars`` (sorted distinct plates seen there,
    targets included, comma separated) and ``car_count``. A list is a filter on
    the read of the targets' passes; their cells are semi-joined to the passes,
    whose plates are gathered per cell within the tasks first: no pair of passes
    is ever formed. The range's label is written once per cell.
    """
    day, hour, start_min = range_cell("action_time")
    passes = legal_cars(flow).select("monitor_id", day.alias("day"), hour.alias("hour"), start_min.alias("start_min"), "car")
    if isinstance(targets, DataFrame):
        of_targets = passes.join(targets.select("car").distinct(), "car", "left_semi")
    else:
        of_targets = passes.filter(F.col("car").isin(list(dict.fromkeys(targets))))
    # the cells with a label; they hold no nulls, so a null-safe match equals a
    # plain equi-join (and keeps the optimizer from working the parts out once
    # more in a filter for them)
    cells = (of_targets.filter(F.col("monitor_id").isNotNull() & cell_label(*map(F.col, _CELL[1:])).isNotNull())
             .select(*[F.col(c).alias(f"_{c}") for c in _CELL]).distinct())
    seen = passes.join(cells, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _CELL], "left_semi")
    return (seen.groupBy(*_CELL).agg(F.array_sort(F.collect_set("car")).alias("cars"))
            .select("monitor_id", cell_label(*map(F.col, _CELL[1:])).alias("range_time"),
                    F.array_join("cars", ",").alias("cars"), F.size("cars").cast("long").alias("car_count")))
