from pyspark.sql import functions as F

from conftest import SF001, flow_rows
from plan_nodes import exchanges
from roadlens.operators.area import area_road_topn
from roadlens.operators.cube import flow_groupings
from roadlens.operators.flow import flow_by_date
from roadlens.operators.monitor import monitor_flow, speed_bands
from roadlens.operators.sketches import ERROR_BOUND, cars_in_ranges, daily_sketches
from roadlens.sources.events import read_passes


def test_one_scan_equals_the_separate_queries(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    df = flow_groupings(flow)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and len(exchanges(df)) == 1
    rows = df.collect()
    by_monitor = {r.monitor_id: r for r in rows if r.grouping == 0b1101}
    assert {m: r.passes for m, r in by_monitor.items()} == {r.monitor_id: r.car_count for r in monitor_flow(flow).collect()}
    for r in speed_bands(flow).collect():
        got = by_monitor[r.monitor_id]
        assert (got.high_count, got.medium_count, got.normal_count, got.low_count) == tuple(r)[1:]
    roads = {(r.area_id, r.road_id): r.passes for r in rows if r.grouping == 0b0011}
    assert roads == {tuple(r)[:2]: r[2] for r in flow.groupBy("area_id", "road_id").count().collect()}
    assert [r.passes for r in rows if r.grouping == 0b1111] == [flow.count()]
    assert sum(r.passes for r in rows if r.grouping == 0b1100) == flow.count()


def test_null_dimensions_are_groups_of_their_own(spark):
    flow = flow_rows(spark, [("A", "2024-01-01 10:00:00", None, "1", "x"), ("B", "2024-01-01 10:00:00", "m", "1", "130")])
    rows = {(r.monitor_id, r.grouping): (r.passes, r.high_count, r.max_speed) for r in flow_groupings(flow, [["monitor_id"], []]).collect()}
    assert rows == {(None, 0b1101): (1, 0, None), ("m", 0b1101): (1, 1, 130), (None, 0b1111): (2, 1, 130)}
    assert flow_groupings(flow.limit(0), [["monitor_id"]]).count() == 0


def test_sketches_of_any_range_are_within_their_bound(spark, tmp_path):
    # 20,000 cars a day, half of them the next day too
    days = [f"2024-01-0{d}" for d in range(1, 6)]
    rows = None
    for i, day in enumerate(days):
        part = spark.range(i * 10_000, i * 10_000 + 20_000).select(
            F.lit(day).alias("date"), F.concat(F.lit("C"), "id").alias("car"), (F.col("id") % 3).cast("string").alias("monitor_id"))
        rows = part if rows is None else rows.unionByName(part)
    daily_sketches(rows.filter("date < '2024-01-04'"), ["monitor_id"]).write.parquet(str(tmp_path / "s"))
    daily_sketches(rows.filter("date >= '2024-01-04'"), ["monitor_id"]).write.mode("append").parquet(str(tmp_path / "s"))
    sketches = spark.read.parquet(str(tmp_path / "s"))
    assert sketches.count() == 15
    ranges = spark.createDataFrame([(days[0], days[0]), (days[1], days[3]), (days[0], days[4]), ("2023", "2023")],
                                   "start_date string, end_date string")
    exact = {(days[0], days[0]): 20_000, (days[1], days[3]): 40_000, (days[0], days[4]): 60_000}
    found = {(r.start_date, r.end_date): r.cars for r in cars_in_ranges(sketches, ranges).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[k] - n) <= ERROR_BOUND * n for k, n in exact.items())
    by_monitor = cars_in_ranges(sketches, ranges, ["monitor_id"]).filter("start_date = end_date").collect()
    assert len(by_monitor) == 3 and all(abs(r.cars - 20_000 / 3) <= ERROR_BOUND * 20_000 / 3 + 1 for r in by_monitor)
