"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (passes come from ``events`` through
the adapter, areas from ``region``) over the whole date range, except where
the date range is the operator's own parameter (``flow_by_date``, the day
checked by ``monitor_state``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.functions import (
    after, before, date_hour, format_date_key, format_double_binary, format_time_minute, is_empty, kv_field, kv_map, kv_set_field,
    lenient_seconds, minus_seconds, pad2, parse_time, range_label, seconds_text, trim_comma,
)
from roadlens.operators.area import area_road_topn
from roadlens.operators.companions import companions
from roadlens.operators.cube import flow_groupings
from roadlens.operators.flow import flow_by_date
from roadlens.operators.follow import follow_car
from roadlens.operators.monitor import (
    camera_registry, monitor_camera_state, monitor_flow, monitor_state, speed_bands,
    speed_rank_monitor, speed_top10_detail, topn_monitor, topn_monitor_detail,
)
from roadlens.operators.sample import (
    hourly_car_count, hourly_quota, sample_cars, sample_detail, sample_track,
)
from roadlens.operators.paths import many_path_conversion, many_path_counts
from roadlens.operators.sketches import ERROR_BOUND, cars_in_ranges, daily_sketches
from roadlens.operators.track import car_track, car_track_blocks, path_conversion, path_step_counts
from roadlens.plans import params as P
from roadlens.plans.tasks import run_task
from roadlens.schema import DETAIL_COLUMNS, FLOW_COLUMNS
from roadlens.session import scratch_path
from roadlens.sources.catalog import save_flow_catalog
from roadlens.sources.commit import read_committed
from roadlens.sources.events import area_from_region, passes_from_events, read_passes
from roadlens.sources.files import load_tsv, write_tsv
from roadlens.sources.lookup import find_cars, save_lookup_table
from roadlens.sources.sink import read_result, write_result
from roadlens.sources.tasks import parse_task_params
from roadlens.streaming.live_flow import events_stream, run_events_flow, start_to_files
from roadlens.streaming.live_topn import LiveCounts, start_live_counts

Query = Callable[[SparkSession, str], DataFrame]


def _flow(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return flow_by_date(read_passes(spark, sf_dir, start, end), start, end)


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_from_region(spark.read.parquet(f"{sf_dir}/region.parquet"))


def q_flow_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir, P.RANGE_START, P.RANGE_END).select(*FLOW_COLUMNS)


def q_load_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_dir = scratch_path(spark, "flow-tsv")
    write_tsv(read_passes(spark, sf_dir), text_dir)
    return load_tsv(spark, text_dir, scratch_path(spark, "flow-table"))


def q_camera_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera_registry(_flow(spark, sf_dir))


def q_path_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_step_counts(_flow(spark, sf_dir), P.PATH)


def q_path_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_conversion(_flow(spark, sf_dir), P.PATH)


def q_car_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return car_track(_flow(spark, sf_dir))


def q_car_track_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return car_track_blocks(_flow(spark, sf_dir), P.TRACK_BLOCK)


def q_hourly_car_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_car_count(_flow(spark, sf_dir))


def q_hourly_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_quota(_flow(spark, sf_dir), P.EXTRACT_NUM)


def q_sample_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_cars(_flow(spark, sf_dir), P.EXTRACT_NUM, P.SEED)


def q_sample_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = _flow(spark, sf_dir)
    return sample_detail(flow, sample_cars(flow, P.EXTRACT_NUM, P.SEED)).select(*DETAIL_COLUMNS)


def q_sample_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = _flow(spark, sf_dir)
    return sample_track(flow, sample_cars(flow, P.EXTRACT_NUM, P.SEED))


def q_monitor_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor_flow(_flow(spark, sf_dir))


def q_speed_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_bands(_flow(spark, sf_dir))


def q_topn_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn_monitor(_flow(spark, sf_dir), P.TOP_N)


def q_topn_monitor_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = flow_by_date(read_passes(spark, sf_dir), area_name=P.AREA_NAME, areas=_areas(spark, sf_dir))
    return topn_monitor(flow, P.TOP_N)


def q_topn_monitor_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn_monitor_detail(_flow(spark, sf_dir), P.TOP_N)


def q_speed_rank_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_rank_monitor(_flow(spark, sf_dir), P.TOP_N)


def q_speed_top10_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_top10_detail(_flow(spark, sf_dir), P.TOP_N, P.TOP_DETAIL_PER_MONITOR)


def q_area_road_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_road_topn(_flow(spark, sf_dir), _areas(spark, sf_dir), P.AREA_TOP_N)


def q_monitor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = camera_registry(_flow(spark, sf_dir))
    return monitor_state(_flow(spark, sf_dir, P.STATE_DATE, P.STATE_DATE), registry)


def q_monitor_camera_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = camera_registry(_flow(spark, sf_dir))
    return monitor_camera_state(_flow(spark, sf_dir, P.STATE_DATE, P.STATE_DATE), registry)


def q_follow_car(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_car(_flow(spark, sf_dir), P.TARGET_CARS)


def q_stream_monitor_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_events_flow(spark, f"{sf_dir}/events.parquet", scratch_path(spark, "live-flow"),
                          scratch_path(spark, "live-flow-checkpoint"), P.WATERMARK, P.WINDOW)
    return out.select(seconds_text(F.unix_seconds("window_start")).alias("window_start"),
                      seconds_text(F.unix_seconds("window_end")).alias("window_end"),
                      "monitor_id", "passes", "speed_sum", "avg_speed")


def q_write_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = topn_monitor(_flow(spark, sf_dir), P.TOP_N)
    path = scratch_path(spark, "topn-monitor-car-count")
    write_result(top, path, 1)
    write_result(top, path, 1)  # a re-run replaces the task's rows
    return read_result(spark, path, top.schema)


def q_time_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = _flow(spark, sf_dir)
    t = F.col("action_time")
    return flow.select(
        "event_id",
        date_hour(t).alias("date_hour"),
        range_label(t).alias("range_time"),
        format_date_key(parse_time(t)).alias("date_key"),
        format_time_minute(parse_time(t)).alias("minute_key"),
        lenient_seconds(t).alias("pass_seconds"),
    )


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes with blank plates, null monitors and bad times mixed in."""
    n = F.col("event_id")
    passes = read_passes(spark, sf_dir)
    return flow_by_date(passes.withColumns({
        "car": F.when(n % 11 == 0, "").when(n % 11 == 1, None).otherwise(F.col("car")),
        "monitor_id": F.when(n % 13 == 0, None).otherwise(F.col("monitor_id")),
        "action_time": F.when(n % 17 == 0, None).when(n % 17 == 1, "garbage")
        .when(n % 17 == 2, F.substring("action_time", 1, 10)).otherwise(F.col("action_time"))}))


def q_dirty_sample_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_cars(_dirty(spark, sf_dir), P.EXTRACT_NUM, P.SEED)


def q_dirty_topn_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn_monitor_detail(_dirty(spark, sf_dir), P.TOP_N)


def q_time_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = (F.col("camera_id").cast("int") - 50) * 60
    flow = _dirty(spark, sf_dir).withColumn("other", seconds_text(lenient_seconds("action_time") + shift))
    return flow.select("event_id", after("action_time", "other").alias("is_after"),
                       before("action_time", "other").alias("is_before"),
                       minus_seconds("action_time", "other").alias("gap"))


def q_text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("camera_id").cast("int")
    flow = read_passes(spark, sf_dir).withColumns({
        "record": F.concat_ws("|", F.concat(F.lit("type="), "road_id"), F.lit("bad"), F.concat(F.lit("k="), k),
                              F.concat(F.lit("k="), k + 1)),
        "maybe": F.when(k % 3 == 0, "").when(k % 3 == 1, None).otherwise(F.col("car"))})
    return flow.select(
        "event_id", trim_comma(F.concat(F.lit(","), "road_id", F.lit(",,"))).alias("trimmed"),
        is_empty("maybe").alias("empty"), pad2((k % 20).cast("string")).alias("padded"),
        kv_field("record", "k").alias("first_k"), kv_field("record", "none").alias("no_field"),
        kv_set_field("record", "k", "new").alias("changed"), F.try_element_at(kv_map("record"), F.lit("k")).alias("last_k"))


def q_task_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("task_id"),
        F.format_string('{"startDate":["2024-01-05"],"topNum":["%d"],"areaName":["%s"],"cars":["A,%s"]}',
                        F.col("c_custkey") % 9, "c_name", "c_name").alias("task_param"))
    p = tasks.select("task_id", parse_task_params("task_param").alias("p")).select("task_id", "p.*")
    return p.select("task_id", "start_date", "end_date", "top_num", "area_name", "extract_num",
                    F.array_join("cars", "+").alias("cars"), F.size("cars").alias("n_cars"))


def q_many_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return many_path_counts(_flow(spark, sf_dir), P.MANY_PATHS)


def q_many_path_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return many_path_conversion(_flow(spark, sf_dir), P.MANY_PATHS)


def _catalog_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passes, from a catalog table laid out by plate and slice."""
    path = scratch_path(spark, "catalog-flow")
    table = "flow_" + path.rsplit("-", 1)[1]
    return flow_by_date(save_flow_catalog(read_passes(spark, sf_dir), table, P.CATALOG_BUCKETS, path))


def q_catalog_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_step_counts(_catalog_flow(spark, sf_dir), P.PATH)


def q_catalog_car_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return car_track(_catalog_flow(spark, sf_dir))


def q_live_topn_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "live-counts")
    stream = passes_from_events(events_stream(spark, f"{sf_dir}/events.parquet"))
    start_live_counts(stream, out, scratch_path(spark, "live-counts-checkpoint")).awaitTermination()
    return LiveCounts(spark, out).top(P.TOP_N)


def q_live_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.streaming.live_paths import live_path_counts  # needs pandas

    out = scratch_path(spark, "live-paths")
    stream = passes_from_events(events_stream(spark, f"{sf_dir}/events.parquet"))
    start_to_files(live_path_counts(stream, P.MANY_PATHS, P.WATERMARK), out,
                   scratch_path(spark, "live-paths-checkpoint")).awaitTermination()
    return spark.read.parquet(out).groupBy("path_id", "step").agg(F.sum("cnt").alias("cnt"))


def q_companions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companions(read_passes(spark, sf_dir), P.TARGET_CARS, P.COMPANION_SECONDS)


def q_find_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lookup-table")
    save_lookup_table(read_passes(spark, sf_dir), path)
    return find_cars(spark, path, P.LOOKUP_CARS, P.RANGE_START, P.RANGE_END)


def q_sketch_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cars of date ranges, exact and from stored sketches, and whether these are within their bound."""
    flow, path = _flow(spark, sf_dir), scratch_path(spark, "daily-sketches")
    daily_sketches(flow).write.parquet(path)
    ranges = spark.createDataFrame(P.SKETCH_RANGES, "start_date string, end_date string")
    keys = ["start_date", "end_date"]
    exact = (flow.join(F.broadcast(ranges), F.col("date").between(*map(F.col, keys)))
             .groupBy(*keys).agg(F.count_distinct("car").alias("exact")))
    found = exact.join(cars_in_ranges(spark.read.parquet(path), ranges), keys, "left")
    return found.select(*keys, F.col("exact").alias("cars"),
                        (F.abs(F.col("cars") - F.col("exact")) <= F.col("exact") * ERROR_BOUND).alias("within_bound"))


def q_flow_groupings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_groupings(_flow(spark, sf_dir))


def q_binary_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", *[
        format_double_binary(sign * price * factor, 2).alias(name)
        for name, factor in (("unit", 1.0), ("half_cents", 0.5), ("tax", 1 + F.col("l_tax")))])


def _task_table(task_id: int, table: str) -> Query:
    """A result table of a stored task, as its commit shows it."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tasks = spark.createDataFrame(list(P.TASKS.items()), "task_id int, task_param string")
        out, passes = scratch_path(spark, "task-results"), read_passes(spark, sf_dir)
        run_task(spark, tasks, task_id, passes, camera_registry(passes), _areas(spark, sf_dir), out, published=False)
        return read_committed(spark, out, table)

    query.__name__ = f"q_task_{table}"
    return query


QUERIES: dict[str, Query] = {
    "flow_by_date": q_flow_by_date,
    "load_tsv": q_load_tsv,
    "camera_registry": q_camera_registry,
    "time_labels": q_time_labels,
    "path_step_counts": q_path_step_counts,
    "path_conversion": q_path_conversion,
    "car_track": q_car_track,
    "car_track_blocks": q_car_track_blocks,
    "hourly_car_count": q_hourly_car_count,
    "hourly_quota": q_hourly_quota,
    "sample_cars": q_sample_cars,
    "sample_detail": q_sample_detail,
    "sample_track": q_sample_track,
    "monitor_flow": q_monitor_flow,
    "topn_monitor": q_topn_monitor,
    "topn_monitor_area": q_topn_monitor_area,
    "topn_monitor_detail": q_topn_monitor_detail,
    "speed_bands": q_speed_bands,
    "speed_rank_monitor": q_speed_rank_monitor,
    "speed_top10_detail": q_speed_top10_detail,
    "area_road_topn": q_area_road_topn,
    "monitor_state": q_monitor_state,
    "monitor_camera_state": q_monitor_camera_state,
    "follow_car": q_follow_car,
    "stream_monitor_speed": q_stream_monitor_speed,
    "write_result": q_write_result,
    "dirty_sample_cars": q_dirty_sample_cars,
    "dirty_topn_detail": q_dirty_topn_detail,
    "time_arithmetic": q_time_arithmetic,
    "text_functions": q_text_functions,
    "task_parameters": q_task_parameters,
    "many_path_counts": q_many_path_counts,
    "many_path_conversion": q_many_path_conversion,
    "catalog_path_counts": q_catalog_path_counts,
    "catalog_car_track": q_catalog_car_track,
    "live_topn_monitor": q_live_topn_monitor,
    "live_path_counts": q_live_path_counts,
    "companions": q_companions,
    "find_cars": q_find_cars,
    "sketch_cars": q_sketch_cars,
    "flow_groupings": q_flow_groupings,
    "binary_rounding": q_binary_rounding,
    **{f"task_{table}": _task_table(task_id, table) for task_id, table in (
        (1, "monitor_state"), (1, "topn_monitor_car_count"), (1, "topn_monitor_detail_info"), (1, "top10_speed_detail"),
        (2, "random_extract_car"), (2, "random_extract_car_detail_info"), (2, "car_track"),
        (3, "monitor_range_time_car"))},
}
