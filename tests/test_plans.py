import os
import tempfile

from conftest import SF001
from roadlens.operators.monitor import camera_registry
from roadlens.plans.tasks import run_task
from roadlens.schema import TASK_SCHEMA
from roadlens.sources.events import area_from_region, read_passes

DAY = "2024-01-05"


def _tasks(spark):
    span = f'"startDate":["{DAY}"],"endDate":["{DAY}"]'
    rows = [
        (1, "flow", '{' + span + ',"topNum":["5"],"areaName":["ASIA"]}'),
        (2, "sample", '{' + span + ',"extractNum":["100"]}'),
        (3, "follow", '{' + span + ',"cars":["U00001,U00002,U00003"]}'),
        (4, "area", '{' + span + '}'),
        (5, "path", '{' + span + ',"roadFlow":["0001,0002,0003,0004,0005"]}'),
    ]
    return spark.createDataFrame([(i, n, None, None, None, None, None, p) for i, n, p in rows], TASK_SCHEMA)


def test_run_all_tasks(spark):
    out = tempfile.mkdtemp(prefix="roadlens-tasks-")
    flow = read_passes(spark, SF001)
    registry = camera_registry(flow)
    areas = area_from_region(spark.read.parquet(f"{SF001}/region.parquet"))
    tasks = _tasks(spark)
    written = {}
    for tid in range(1, 6):
        written[tid] = run_task(spark, tasks, tid, flow, registry, areas, out)
    assert written[1] == ["monitor_state", "top10_speed_detail", "topn_monitor_car_count", "topn_monitor_detail_info"]
    assert written[2] == ["car_track", "random_extract_car", "random_extract_car_detail_info"]
    assert written[3] == ["monitor_range_time_car"]
    assert written[4] == ["area_road_topn"]
    assert written[5] == ["path_conversion_rate", "path_step_count"]
    picked = spark.read.parquet(os.path.join(out, "random_extract_car"))
    # one day, extract 100: the sum of hourly quotas is at most 100
    assert 0 < picked.count() <= 100
    assert picked.filter(f"date_d != '{DAY}'").count() == 0
    top = spark.read.parquet(os.path.join(out, "topn_monitor_car_count")).collect()
    assert len(top) == 5 and all(r["task_id"] == 1 for r in top)
    assert "taskId" in spark.read.parquet(os.path.join(out, "monitor_state")).columns
    # rerun replaces, never duplicates
    run_task(spark, tasks, 1, flow, registry, areas, out)
    assert spark.read.parquet(os.path.join(out, "topn_monitor_car_count")).count() == 5
    assert run_task(spark, tasks, 99, flow, registry, areas, out) == []


def test_command_line_jobs(spark):
    import json

    from roadlens.plans.jobs import main
    from roadlens.sources.files import write_tsv

    base = tempfile.mkdtemp(prefix="roadlens-jobs-")
    write_tsv(read_passes(spark, SF001), os.path.join(base, "files"))
    assert main(["load", "--files", os.path.join(base, "files"), "--table", os.path.join(base, "flow")], spark)
    with open(os.path.join(base, "tasks.jsonl"), "w") as fh:
        fh.write(json.dumps({"task_id": 5, "task_param": json.dumps(
            {"startDate": ["2024-01-01"], "endDate": ["2024-01-30"], "roadFlow": ["0001,0002,0003,0004,0005"]})}) + "\n")
    written = main(["run-task", "--task-id", "5", "--table", os.path.join(base, "flow"),
                    "--tasks", os.path.join(base, "tasks.jsonl"), "--out", os.path.join(base, "out")], spark)
    assert written == ["path_conversion_rate", "path_step_count"]
    rates = spark.read.parquet(os.path.join(base, "out", "path_conversion_rate")).collect()
    assert [(r["path"], r["rate"]) for r in rates] == [("0001,0002", 0.13)]


def test_task_results_equal_the_operators(spark):
    from roadlens.operators.area import area_road_topn
    from roadlens.operators.flow import flow_by_date
    from roadlens.operators.follow import follow_car
    from roadlens.operators.monitor import monitor_state, topn_monitor
    from roadlens.operators.track import path_conversion

    out = tempfile.mkdtemp(prefix="roadlens-tasks-eq-")
    flow = read_passes(spark, SF001)
    registry = camera_registry(flow)
    areas = area_from_region(spark.read.parquet(f"{SF001}/region.parquet"))
    tasks = _tasks(spark)
    for tid in (1, 3, 4, 5):
        run_task(spark, tasks, tid, flow, registry, areas, out)
    day = flow_by_date(flow, DAY, DAY)

    def table(name, cols):
        return sorted(map(tuple, spark.read.parquet(os.path.join(out, name)).select(*cols).collect()))

    def rows(df, cols):
        return sorted(map(tuple, df.select(*cols).collect()))

    cols = ["step", "path", "cnt", "prev_cnt", "rate"]
    assert table("path_conversion_rate", cols) == rows(path_conversion(day, ["0001", "0002", "0003", "0004", "0005"]), cols)
    cols = ["monitor_id", "range_time", "cars"]
    assert table("monitor_range_time_car", cols) == rows(follow_car(day, ["U00001", "U00002", "U00003"]), cols)
    cols = ["area_id", "area_name", "road_id", "car_count", "rank"]
    assert table("area_road_topn", cols) == rows(area_road_topn(day, areas, 3), cols)
    in_asia = flow_by_date(flow, DAY, DAY, "ASIA", areas)
    assert table("topn_monitor_car_count", ["monitor_id", "carCount"]) == rows(topn_monitor(in_asia, 5), ["monitor_id", "car_count"])
    cols = ["normal_camera_count", "abnormal_monitor_count", "abnormal_camera_count", "abnormal_monitor_camera_infos"]
    asia_registry = registry.join(flow_by_date(flow, area_name="ASIA", areas=areas).select("monitor_id"),
                                  "monitor_id", "left_semi")
    assert (table("monitor_state", ["noraml_monitor_count"] + cols)
            == rows(monitor_state(in_asia, asia_registry), ["normal_monitor_count"] + cols))
