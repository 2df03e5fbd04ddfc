"""The stored analysis tasks as end-to-end jobs.

A task row names its parameters (JSON); ``run_task`` reads that one row,
builds the result DataFrames with the operators, and commits all result tables
at once (see ``sources.commit``): a task that fails leaves the tables of its
last run, a rerun replaces them. Nothing is written from inside a
transformation.

| task kind        | parameters                               | result tables |
| ---------------- | ---------------------------------------- | ------------- |
| monitor flow     | startDate, endDate, topNum, [areaName]   | monitor_state, topn_monitor_car_count, topn_monitor_detail_info, top10_speed_detail |
| random sample    | startDate, endDate, extractNum           | random_extract_car, random_extract_car_detail_info, car_track |
| follow car       | startDate, endDate, cars                 | monitor_range_time_car |
| area top-N       | startDate, endDate                       | area_road_topn |
| path conversion  | startDate, endDate, roadFlow             | path_step_count, path_conversion_rate |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.area import area_road_topn
from roadlens.operators.flow import flow_by_date
from roadlens.operators.follow import follow_car
from roadlens.operators.monitor import (
    monitor_state, speed_top10_detail, topn_monitor, topn_monitor_detail,
)
from roadlens.operators.sample import sample_cars, sample_detail
from roadlens.operators.track import car_track, conversion_rates, path_step_counts
from roadlens.schema import DETAIL_COLUMNS
from roadlens.session import materialize
from roadlens.sources.commit import commit_results, recover
from roadlens.sources.sink import write_jdbc
from roadlens.sources.tasks import task_params

# Fixed names: result tables whose task column is not task_id.
TASK_COLUMNS = {"monitor_state": "taskId"}

DEFAULT_AREA_TOP_N = 3
DEFAULT_SEED = 42


def monitor_flow_results(flow: DataFrame, registry: DataFrame, p, areas: DataFrame | None = None) -> dict[str, DataFrame]:
    passes = flow_by_date(flow, p["start_date"], p["end_date"], p["area_name"], areas if p["area_name"] else None)
    n = p["top_num"] or 5
    if p["area_name"]:
        # health inside an area: only monitors that ever report in that area count
        in_area = flow_by_date(flow, area_name=p["area_name"], areas=areas).select("monitor_id").distinct()
        registry = registry.join(in_area, "monitor_id", "left_semi")
    state = monitor_state(passes, registry)
    return {
        # column names as in the existing result table, misspelling included
        "monitor_state": state.withColumnRenamed("normal_monitor_count", "noraml_monitor_count"),
        "topn_monitor_car_count": topn_monitor(passes, n).select("monitor_id", F.col("car_count").alias("carCount")),
        "topn_monitor_detail_info": topn_monitor_detail(passes, n),
        "top10_speed_detail": speed_top10_detail(passes, n, 10),
    }


def sample_results(flow: DataFrame, p, seed: int = DEFAULT_SEED) -> dict[str, DataFrame]:
    passes = flow_by_date(flow, p["start_date"], p["end_date"])
    extract_num = p["extract_num"] or 0
    # the sample is small (at most extract_num rows) and feeds two results:
    # compute it once and cut its lineage
    picked = materialize(sample_cars(passes, extract_num, seed), "sampled-cars")
    detail = materialize(sample_detail(passes, picked), "sampled-passes")  # read for two results
    return {
        "random_extract_car": picked.select(F.col("car").alias("car_info"), F.col("date").alias("date_d"), "date_hour"),
        "random_extract_car_detail_info": detail.select(*DETAIL_COLUMNS),
        "car_track": car_track(detail),
    }


def follow_results(flow: DataFrame, p) -> dict[str, DataFrame]:
    passes = flow_by_date(flow, p["start_date"], p["end_date"])
    cars = [c.strip() for c in (p["cars"] or []) if c and c.strip()]
    return {"monitor_range_time_car": follow_car(passes, cars).select("monitor_id", "range_time", "cars")}


def area_results(flow: DataFrame, areas: DataFrame, p, n: int = DEFAULT_AREA_TOP_N) -> dict[str, DataFrame]:
    passes = flow_by_date(flow, p["start_date"], p["end_date"])
    return {"area_road_topn": area_road_topn(passes, areas, n)}


def path_results(flow: DataFrame, p) -> dict[str, DataFrame]:
    passes = flow_by_date(flow, p["start_date"], p["end_date"])
    path = [m.strip() for m in p["road_flow"]]
    counts = materialize(path_step_counts(passes, path), "path-counts")  # one row a step, for two results
    return {"path_step_count": counts, "path_conversion_rate": conversion_rates(counts)}


def task_results(spark: SparkSession, tasks: DataFrame, task_id: int, flow: DataFrame,
                 registry: DataFrame, areas: DataFrame) -> dict[str, DataFrame]:
    """Result DataFrames of one task; the kind follows from its parameters."""
    rows = task_params(tasks, task_id).take(1)
    if not rows:
        return {}
    p = rows[0]
    if p["road_flow"]:
        return path_results(flow, p)
    if p["cars"]:
        return follow_results(flow, p)
    if p["extract_num"] is not None:
        return sample_results(flow, p)
    if p["top_num"] is not None:
        return monitor_flow_results(flow, registry, p, areas)
    return area_results(flow, areas, p)


def run_task(spark: SparkSession, tasks: DataFrame, task_id: int, flow: DataFrame,
             registry: DataFrame, areas: DataFrame, out_dir: str | None, out_jdbc: str | None = None,
             published: bool = True) -> list[str]:
    """Run one task and write its result tables; returns their names.

    They are committed together below ``out_dir`` and, unless ``published`` is
    false, copied to the plain tables there (with those of earlier runs whose
    copy broke off); with ``out_jdbc``, they also go to the database's tables
    of the same names.
    """
    results = task_results(spark, tasks, task_id, flow, registry, areas)
    if results and out_dir:
        commit_results(spark, results, out_dir, task_id, TASK_COLUMNS)
        if published:
            recover(spark, out_dir)
    if out_jdbc:
        for name, df in results.items():
            write_jdbc(df, out_jdbc, name, task_id, task_column=TASK_COLUMNS.get(name, "task_id"))
    return sorted(results)
