"""Pass selection: date range, legal plates, optional area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.operators.common import legal_cars


def flow_by_date(flow: DataFrame, start_date: str | None = None, end_date: str | None = None,
                 area_name: str | None = None, areas: DataFrame | None = None) -> DataFrame:
    """Passes with ``start_date <= date <= end_date`` (both inclusive) and a plate.

    On a table partitioned by the string ``date`` the range prunes
    partitions. With ``area_name`` the passes are restricted to the areas of
    that name (a semi join to the area dimension).
    """
    out = flow
    if start_date is not None:
        out = out.filter(F.col("date") >= F.lit(start_date))
    if end_date is not None:
        out = out.filter(F.col("date") <= F.lit(end_date))
    out = legal_cars(out)
    if area_name is not None:
        if areas is None:
            raise ValueError("area_name needs the area dimension")
        wanted = areas.filter(F.col("area_name") == F.lit(area_name)).select("area_id")
        out = out.join(wanted, "area_id", "left_semi")
    return out
