"""Task parameters.

A task row carries its parameters as JSON whose values are arrays holding
one string, e.g. ``{"startDate":["2018-07-01"],"topNum":["5"]}``. The parsed
form is one row of typed columns, joined or read as a scalar by callers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed parameter names used by the stored tasks.
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_TOP_NUM = "topNum"
PARAM_AREA_NAME = "areaName"
PARAM_EXTRACT_NUM = "extractNum"
PARAM_CARS = "cars"
PARAM_ROAD_FLOW = "roadFlow"

_PARAM_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def _first(params: Column, key: str) -> Column:
    return F.get(params.getItem(key), 0)


def parse_task_params(param_json: str | Column) -> Column:
    """JSON parameter text to a struct of typed fields (null when absent)."""
    c = F.col(param_json) if isinstance(param_json, str) else param_json
    m = F.from_json(c, _PARAM_TYPE)
    return F.struct(
        _first(m, PARAM_START_DATE).alias("start_date"),
        _first(m, PARAM_END_DATE).alias("end_date"),
        _first(m, PARAM_TOP_NUM).try_cast(T.IntegerType()).alias("top_num"),
        _first(m, PARAM_AREA_NAME).alias("area_name"),
        _first(m, PARAM_EXTRACT_NUM).try_cast(T.IntegerType()).alias("extract_num"),
        F.split(_first(m, PARAM_CARS), ",").alias("cars"),
        F.split(_first(m, PARAM_ROAD_FLOW), ",").alias("road_flow"),
    )


def task_params(tasks: DataFrame, task_id: int) -> DataFrame:
    """The parsed parameters of one task: zero rows when the id is unknown."""
    return (tasks.filter(F.col("task_id") == F.lit(task_id))
                 .select("task_id", parse_task_params("task_param").alias("p"))
                 .select("task_id", "p.*"))
