"""Catalog tables laid out by plate and time slice."""

import json
import os
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, flow_rows
from plan_nodes import exchanges
from roadlens.operators.flow import flow_by_date
from roadlens.operators.track import car_track, path_step_counts
from roadlens.session import scratch_path
from roadlens.sources.catalog import load_catalog, save_flow_catalog
from roadlens.sources.events import read_passes
from roadlens.sources.files import read_flow_catalog, write_tsv

PATH = ["0001", "0002", "0003"]
PASS_COLUMNS = {"action_time", "monitor_id", "camera_id", "label", "runs", "steps", "buf"}


@pytest.fixture
def table(spark):
    name = "flow_" + uuid.uuid4().hex[:8]
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df):
    return sorted(map(str, df.collect()))


def test_tracks_and_paths_do_not_exchange_passes(spark, table):
    flow = flow_by_date(read_passes(spark, SF001))
    laid = flow_by_date(save_flow_catalog(flow, table, 4, scratch_path(spark, "catalog")))
    for operator in (lambda f: path_step_counts(f, PATH), car_track):
        plain = [c for _, c in exchanges(operator(flow)) if PASS_COLUMNS & set(c)]
        stored = [c for _, c in exchanges(operator(laid)) if PASS_COLUMNS & set(c) - {"buf"} or "t" in c]
        assert plain and not stored
        assert rows(operator(laid)) == rows(operator(flow))
    # what is left of the path plan: the ends of slices by car, the states, the steps
    assert len(exchanges(path_step_counts(laid, PATH))) == 3
    assert "Bucketed: true" in path_step_counts(laid, PATH)._jdf.queryExecution().executedPlan().toString()


def test_a_hot_plate_is_spread_over_the_buckets(spark, table):
    flow = read_passes(spark, SF001).withColumn("car", F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("car")))
    path = scratch_path(spark, "catalog")
    save_flow_catalog(flow, table, 4, path)
    sizes = {r["b"]: r["n"] for r in spark.read.parquet(path).filter("car = 'HOT'").groupBy(
        F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).alias("b")).agg(F.count("*").alias("n")).collect()}
    assert len(sizes) == 4 and max(sizes.values()) < sum(sizes.values()) / 2


def test_a_load_replaces_the_table_and_dates_prune(spark, table):
    flow = read_passes(spark, SF001)
    path = scratch_path(spark, "catalog")
    save_flow_catalog(flow, table, 4, path)
    back = save_flow_catalog(flow.filter("date >= '2024-01-10'"), table, 2, path)
    assert back.agg(F.min("date")).first()[0] == "2024-01-10"
    day = flow_by_date(read_flow_catalog(spark, table), "2024-01-12", "2024-01-12")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-12", plan)
    assert day.select("car", "action_time").exceptAll(
        flow_by_date(flow, "2024-01-12", "2024-01-12").select("car", "action_time")).count() == 0


def test_odd_rows(spark, table):
    flow = flow_rows(spark, [("A", "2024-01-01 25:00:00", "0001"), ("A", "garbage", "0002"), ("A", "garbage", None),
                             ("B", "2024-01-01 10:00:00", "0001"), (None, "2024-01-01 10:00:00", "0001")])
    laid = save_flow_catalog(flow, table, 2, scratch_path(spark, "catalog"))
    assert laid.count() == 5
    assert rows(car_track(laid)) == rows(car_track(flow))
    empty = save_flow_catalog(flow.limit(0), table, 2, scratch_path(spark, "catalog"))
    assert car_track(empty).count() == 0


def test_command_line_with_table_names(spark, table, tmp_path):
    from roadlens.plans.jobs import main
    files, registry_files = str(tmp_path / "files"), str(tmp_path / "registry")
    passes = read_passes(spark, SF001)
    write_tsv(passes, files)
    write_tsv(passes.select("monitor_id", "camera_id").distinct(), registry_files, ["monitor_id", "camera_id"])
    registry = table + "_registry"
    try:
        assert main(["load", "--files", files, "--table", table, "--catalog", "--buckets", "2",
                     "--registry-files", registry_files, "--registry-table", registry], spark) == [table]
        with open(tmp_path / "tasks.jsonl", "w") as fh:
            for task, param in ((1, {"topNum": ["5"]}), (5, {"roadFlow": ["0001,0002,0003,0004,0005"]})):
                fh.write(json.dumps({"task_id": task, "task_param": json.dumps(
                    {"startDate": ["2024-01-01"], "endDate": ["2024-01-30"], **param})}) + "\n")
        for task in ("1", "5"):
            main(["run-task", "--task-id", task, "--table", table, "--registry", registry, "--catalog",
                  "--tasks", str(tmp_path / "tasks.jsonl"), "--out", str(tmp_path / "out")], spark)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {registry}")
    rates = spark.read.parquet(str(tmp_path / "out" / "path_conversion_rate")).collect()
    assert [(r["path"], r["rate"]) for r in rates] == [("0001,0002", 0.13)]
    state = spark.read.parquet(str(tmp_path / "out" / "monitor_state")).first()
    assert state["noraml_monitor_count"] + state["abnormal_monitor_count"] == 9
