"""Cars that travel with target cars: passes at the same monitor within a time span."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.dates import lenient_seconds
from roadlens.operators.common import legal_cars


def companions(flow: DataFrame, targets: list[str], seconds: int = 120) -> DataFrame:
    """``target, car, meetings, closest_seconds`` for every car seen with a target.

    A meeting is a moment (monitor and second) of the target at which the car
    passed the same monitor at most ``seconds`` before or after. Unlike fixed
    cells, the span follows the target, across any boundary.

    An interval join by time bins of twice the span: a pass lies in one bin, a
    target's moment in the one or two that its span touches, so bins deal a
    busy monitor over tasks and only rows of a bin meet. Both sides are
    distinct moments before they meet, and a car that passes several times
    within a span is one meeting. Times that do not parse meet nobody.
    """
    if seconds < 0:
        raise ValueError("a span is not negative")
    width = max(2 * seconds, 1)
    # a list argument is a filter on the scan, not a join
    moments = (legal_cars(flow).select("monitor_id", "car", lenient_seconds("action_time").alias("t"))
               .filter(F.col("monitor_id").isNotNull() & F.col("t").isNotNull()))
    bins = F.sequence(F.floor((F.col("at") - seconds) / width), F.floor((F.col("at") + seconds) / width))
    wanted = (moments.filter(F.col("car").isin(list(dict.fromkeys(targets))))
              .select(F.col("car").alias("target"), F.col("monitor_id").alias("place"), F.col("t").alias("at")).distinct()
              .withColumn("bin", F.explode(bins)))
    seen = moments.distinct().withColumn("in_bin", F.floor(F.col("t") / width))
    gap = F.abs(F.col("t") - F.col("at"))
    met = seen.join(wanted, (F.col("monitor_id") == F.col("place")) & (F.col("in_bin") == F.col("bin"))
                    & (gap <= seconds) & (F.col("car") != F.col("target")))
    return (met.groupBy("target", "car", "place", "at").agg(F.min(gap).alias("gap"))
            .groupBy("target", "car").agg(F.count(F.lit(1)).alias("meetings"), F.min("gap").alias("closest_seconds")))
