import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from roadlens.operators.flow import flow_by_date
from roadlens.schema import FLOW_COLUMNS, TASK_SCHEMA
from roadlens.session import scratch_path, shared_dir
from roadlens.sources.events import area_from_region, read_passes
from roadlens.sources.files import load_tsv, read_flow_table, write_tsv
from roadlens.sources.sink import read_result, write_result
from roadlens.sources.tasks import task_params


def test_adapter_shape(spark):
    flow = read_passes(spark, SF001)
    assert flow.columns == FLOW_COLUMNS + ["event_id"]
    stats = flow.agg(F.count("*"), F.countDistinct("car"), F.countDistinct("date"),
                     F.countDistinct("monitor_id"), F.countDistinct("camera_id")).first()
    assert tuple(stats) == (1000, 15, 30, 9, 100)


def test_date_filter_reaches_the_scan(spark):
    df = read_passes(spark, SF001, "2024-01-05", "2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert {r["date"] for r in df.select("date").distinct().collect()} == {"2024-01-05", "2024-01-06"}


def test_tsv_round_trip_keeps_quotes_and_string_dates(spark):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    rows = [("2018-07-01", "0001", "00001", 'A"1', "2018-07-01 25:10:00", "80", "3", "01"),
            ("2018-07-02", "0002", "00002", "B2", "2018-07-02 10:00:00", "90", "4", "02")]
    src = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FLOW_COLUMNS))
    write_tsv(src, os.path.join(base, "text"))
    table = load_tsv(spark, os.path.join(base, "text"), os.path.join(base, "table"))
    assert sorted(map(tuple, table.collect())) == sorted(rows)
    assert dict(table.dtypes)["date"] == "string"
    pruned = flow_by_date(read_flow_table(spark, os.path.join(base, "table")), "2018-07-02", "2018-07-02")
    assert [r["car"] for r in pruned.collect()] == ["B2"]
    assert "PartitionFilters: [isnotnull(date" in pruned._jdf.queryExecution().executedPlan().toString()
    # reloading replaces the partitions instead of adding rows
    table = load_tsv(spark, os.path.join(base, "text"), os.path.join(base, "table"))
    assert table.count() == 2


def test_write_result_is_idempotent(spark):
    path = scratch_path(spark, "result-test")
    df = spark.createDataFrame([("0001", 5), ("0002", 3)], "monitor_id string, car_count long")
    write_result(df, path, 1)
    write_result(df, path, 1)
    write_result(df.limit(1), path, 2)
    back = read_result(spark, path, df.schema)
    assert back.filter("task_id = '1'").count() == 2
    assert back.filter("task_id = '2'").count() == 1
    assert path.startswith(shared_dir(spark))


def test_task_params(spark):
    tasks = spark.createDataFrame([
        (1, "flow", None, None, None, None, None,
         '{"startDate":["2018-07-01"],"endDate":["2018-07-01"],"topNum":["5"],"areaName":["X"]}'),
        (3, "follow", None, None, None, None, None, '{"startDate":["2018-07-01"],"cars":["A,B,C"]}'),
        (5, "path", None, None, None, None, None, '{"roadFlow":["0001,0002,0003"]}'),
    ], TASK_SCHEMA)
    p = task_params(tasks, 1).first()
    assert (p["start_date"], p["end_date"], p["top_num"], p["area_name"]) == ("2018-07-01", "2018-07-01", 5, "X")
    assert task_params(tasks, 3).first()["cars"] == ["A", "B", "C"]
    assert task_params(tasks, 5).first()["road_flow"] == ["0001", "0002", "0003"]
    assert task_params(tasks, 9).count() == 0


def test_area_dimension(spark):
    areas = area_from_region(spark.read.parquet(f"{SF001}/region.parquet"))
    assert sorted(map(tuple, areas.collect()))[0] == ("00", "AFRICA")


def test_catalog_view(spark):
    from roadlens.sources.files import read_flow_catalog
    read_passes(spark, SF001).createOrReplaceTempView("monitor_flow_action")
    assert read_flow_catalog(spark).columns == FLOW_COLUMNS
    assert read_flow_catalog(spark).count() == 1000


def test_adapter_is_time_zone_independent(spark):
    base = {tuple(r) for r in read_passes(spark, SF001, "2024-01-05", "2024-01-06").collect()}
    try:
        for tz in ("America/Los_Angeles", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert {tuple(r) for r in read_passes(spark, SF001, "2024-01-05", "2024-01-06").collect()} == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_registry_files(spark):
    from roadlens.schema import REGISTRY_SCHEMA
    base = tempfile.mkdtemp(prefix="roadlens-reg-")
    flow_src = spark.createDataFrame([("2018-07-01", "0001", "00001", "A1", "2018-07-01 10:00:00", "80", "3", "01")],
                                     ", ".join(f"{c} string" for c in FLOW_COLUMNS))
    write_tsv(flow_src, os.path.join(base, "flow"))
    reg = spark.createDataFrame([("0001", "00001"), ("0001", "00002")], REGISTRY_SCHEMA)
    write_tsv(reg, os.path.join(base, "reg"), ["monitor_id", "camera_id"])
    load_tsv(spark, os.path.join(base, "flow"), os.path.join(base, "flow_t"),
             os.path.join(base, "reg"), os.path.join(base, "reg_t"))
    back = spark.read.schema(REGISTRY_SCHEMA).parquet(os.path.join(base, "reg_t"))
    assert sorted(map(tuple, back.collect())) == [("0001", "00001"), ("0001", "00002")]


def test_load_tolerates_malformed_lines(spark):
    base = tempfile.mkdtemp(prefix="roadlens-bad-")
    os.makedirs(os.path.join(base, "in"))
    lines = ["2018-07-01\t0001\t00001\tA1\t2018-07-01 10:00:00\t80\t1\t01",
             "2018-07-01\t0002\t00002\tB2",                                      # too few fields
             "2018-07-02\t0003\t00003\tC3\t2018-07-02 10:00:00\t90\t2\t02\textra",  # too many
             '2018-07-02\t0004\t"00004\tD"4\t2018-07-02 11:00:00\t70\t3\t03']      # stray quotes
    with open(os.path.join(base, "in", "part-0.tsv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    table = load_tsv(spark, os.path.join(base, "in"), os.path.join(base, "out"))
    rows = {r["car"]: r for r in table.collect()}
    assert set(rows) == {"A1", "B2", "C3", 'D"4'}
    assert rows["B2"]["action_time"] is None and rows["C3"]["area_id"] == "02"
    assert rows['D"4']["camera_id"] == '"00004'
