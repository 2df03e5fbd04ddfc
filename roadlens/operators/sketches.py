"""Distinct cars of any date range from stored daily sketches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from roadlens.operators.common import legal_cars

LG_REGISTERS = 12

#: Three standard errors of a sketch with 2 ** LG_REGISTERS registers, relative to the count.
ERROR_BOUND = 3 * 1.04 / math.sqrt(2 ** LG_REGISTERS)


def daily_sketches(flow: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``date``, the columns ``by`` and ``cars``: a sketch of the plates of that day, of a few KB.

    Sketches add up in any order and over any days, so a stored table of them
    answers every range without the passes; a new day appends its rows.
    """
    return legal_cars(flow).groupBy("date", *(by or [])).agg(F.hll_sketch_agg("car", LG_REGISTERS).alias("cars"))


def cars_in_ranges(sketches: DataFrame, ranges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``start_date, end_date``, the columns ``by`` and ``cars``: distinct cars of each inclusive range of ``ranges``.

    Within ``ERROR_BOUND`` of the exact count (three standard errors); one row
    per day and range is united, not the passes.
    """
    keys = ["start_date", "end_date", *(by or [])]
    days = sketches.join(F.broadcast(ranges), F.col("date").between(F.col("start_date"), F.col("end_date")))
    return days.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("cars")).alias("cars"))
