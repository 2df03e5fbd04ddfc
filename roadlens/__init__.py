"""roadlens: traffic-checkpoint analytics on Spark DataFrames.

Every operator takes DataFrames of passes (``date, monitor_id, camera_id,
car, action_time, speed, road_id, area_id``) and returns a DataFrame built
from built-in Spark SQL expressions.
"""

from roadlens.operators.area import area_road_topn
from roadlens.operators.companions import companions
from roadlens.operators.cube import flow_groupings
from roadlens.operators.flow import flow_by_date
from roadlens.operators.follow import follow_car
from roadlens.operators.monitor import (
    camera_registry, monitor_camera_state, monitor_flow, monitor_state, speed_bands,
    speed_rank_monitor, speed_top10_detail, topn_monitor, topn_monitor_detail,
)
from roadlens.operators.paths import many_path_conversion, many_path_counts
from roadlens.operators.sample import (
    hour_cars, hourly_car_count, hourly_quota, sample_cars, sample_detail, sample_track,
)
from roadlens.operators.sequence import sequence_number
from roadlens.operators.sketches import cars_in_ranges, daily_sketches
from roadlens.operators.track import car_track, car_track_blocks, path_conversion, path_step_counts
from roadlens.plans.tasks import run_task, task_results
from roadlens.sources import (
    area_from_region, commit_results, load_catalog, load_tsv, parse_task_params, passes_from_events, publish,
    read_committed, read_flow_catalog, read_flow_table, read_passes, recover, save_flow_catalog, read_result, read_tsv, task_params, write_jdbc, write_result, write_tsv,
)
from roadlens.sources.lookup import find_cars, save_lookup_table
from roadlens.streaming.live_flow import events_stream, late_rows_dropped, start_to_files, stream_monitor_speed
from roadlens.streaming.live_topn import LiveCounts, start_live_counts
from roadlens.streaming.sources import kafka_pass_stream, parse_pass_lines, text_pass_stream

__all__ = [
    "area_road_topn", "companions", "flow_by_date", "flow_groupings", "follow_car",
    "many_path_conversion", "many_path_counts", "cars_in_ranges", "daily_sketches",
    "commit_results", "publish", "read_committed", "recover", "load_catalog", "save_flow_catalog",
    "find_cars", "save_lookup_table", "LiveCounts", "start_live_counts",
    "camera_registry", "monitor_camera_state", "monitor_flow", "monitor_state", "speed_bands",
    "speed_rank_monitor", "speed_top10_detail", "topn_monitor", "topn_monitor_detail",
    "hour_cars", "hourly_car_count", "hourly_quota", "sample_cars", "sample_detail", "sample_track",
    "sequence_number", "car_track", "car_track_blocks", "path_conversion", "path_step_counts",
    "run_task", "task_results",
    "area_from_region", "load_tsv", "parse_task_params", "passes_from_events", "read_flow_catalog",
    "read_flow_table", "read_passes", "read_result", "read_tsv", "task_params", "write_jdbc",
    "write_result", "write_tsv",
    "events_stream", "late_rows_dropped", "start_to_files", "stream_monitor_speed",
    "kafka_pass_stream", "parse_pass_lines", "text_pass_stream",
]
