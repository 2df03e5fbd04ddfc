"""Top-N roads by flow inside each area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def area_road_topn(flow: DataFrame, areas: DataFrame, n: int = 3) -> DataFrame:
    """Per area, the ``n`` roads with the most passes (ties by road id).

    ``area_id``, ``area_name``, ``road_id``, ``car_count``, ``rank``. Counts are
    aggregated first (map-side combine); ranking and the area-name lookup run
    on the reduced (area, road) rows.
    """
    counts = flow.groupBy("area_id", "road_id").agg(F.count(F.lit(1)).alias("car_count"))
    w = Window.partitionBy("area_id").orderBy(F.desc("car_count"), F.asc("road_id"))
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    # one name per id, chosen deterministically if the dimension repeats an id
    names = areas.groupBy("area_id").agg(F.min("area_name").alias("area_name"))
    return (top.join(names, "area_id", "left")
            .select("area_id", "area_name", "road_id", "car_count", "rank"))
