from conftest import SF001, SF01, flow_rows
from roadlens.operators.area import area_road_topn
from roadlens.operators.flow import flow_by_date
from roadlens.operators.follow import follow_car
from roadlens.operators.monitor import (
    camera_registry, monitor_camera_state, monitor_state, speed_bands, speed_rank_monitor,
    speed_top10_detail, topn_monitor, topn_monitor_detail,
)
from roadlens.sources.events import area_from_region, read_passes


def _flow(spark, sf, start=None, end=None):
    return flow_by_date(read_passes(spark, sf, start, end), start, end)


def test_topn_monitor_expected(spark):
    got = [(r["monitor_id"], r["car_count"]) for r in topn_monitor(_flow(spark, SF01), 5).collect()]
    assert got == [("0000", 1228), ("0006", 1137), ("0001", 1129), ("0008", 1125), ("0003", 1102)]
    got = [(r["monitor_id"], r["car_count"]) for r in topn_monitor(_flow(spark, SF001), 5).collect()]
    assert got == [("0008", 126), ("0004", 121), ("0000", 119), ("0006", 113), ("0001", 112)]


def test_topn_detail_rows(spark):
    flow = _flow(spark, SF001)
    detail = topn_monitor_detail(flow, 5)
    assert detail.count() == 126 + 121 + 119 + 113 + 112
    assert "area_id" not in detail.columns


def test_speed_rank_expected(spark):
    first = speed_rank_monitor(_flow(spark, SF01), 5).first()
    assert (first["monitor_id"], first["high_count"], first["medium_count"], first["normal_count"],
            first["low_count"]) == ("0000", 112, 84, 153, 879)
    first = speed_rank_monitor(_flow(spark, SF001), 5).first()
    assert (first["monitor_id"], first["high_count"], first["medium_count"], first["normal_count"],
            first["low_count"]) == ("0008", 14, 12, 15, 85)


def test_speed_top10_per_monitor(spark):
    flow = _flow(spark, SF01)
    rows = speed_top10_detail(flow, 5, 10).collect()
    assert len(rows) == 50
    by_mon = {}
    for r in rows:
        by_mon.setdefault(r["monitor_id"], []).append(int(r["speed"]))
    for mon, speeds in by_mon.items():
        best = sorted((int(r["speed"]) for r in flow.filter(flow.monitor_id == mon).select("speed").collect()),
                      reverse=True)[:10]
        assert sorted(speeds, reverse=True) == best
    plan = speed_top10_detail(flow, 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_monitor_state_expected(spark):
    registry = camera_registry(_flow(spark, SF01))
    day = _flow(spark, SF01, "2024-01-05", "2024-01-05")
    row = monitor_state(day, registry).first()
    assert (row["normal_monitor_count"], row["normal_camera_count"], row["abnormal_monitor_count"],
            row["abnormal_camera_count"]) == (7, 97, 2, 3)
    assert row["abnormal_monitor_camera_infos"] == "0001:00073~0002:00047,00083"
    registry = camera_registry(_flow(spark, SF001))
    day = _flow(spark, SF001, "2024-01-05", "2024-01-05")
    row = monitor_state(day, registry).first()
    assert (row["normal_monitor_count"], row["normal_camera_count"], row["abnormal_monitor_count"],
            row["abnormal_camera_count"]) == (0, 31, 9, 69)


def test_monitor_state_tiny(spark):
    registry = spark.createDataFrame([("M1", "C1"), ("M1", "C2"), ("M2", "C3")], "monitor_id string, camera_id string")
    flow = flow_rows(spark, [("A", "2018-07-01 10:00:00", "M1", "C1"), ("B", "2018-07-01 10:00:00", "M2", "C3"),
                             ("B", "2018-07-01 10:00:00", "M9", "C9")])
    row = monitor_state(flow, registry).first()
    assert tuple(row) == (1, 2, 1, 1, "M1:C2")
    per = {r["monitor_id"]: tuple(r)[1:] for r in monitor_camera_state(flow, registry).collect()}
    assert per == {"M1": (1, 1, "C2"), "M2": (1, 0, None)}
    row = monitor_state(flow.limit(0), registry).first()
    assert tuple(row) == (0, 0, 2, 3, "M1:C1,C2~M2:C3")


def test_area_road_topn(spark):
    flow = _flow(spark, SF01)
    areas = area_from_region(spark.read.parquet(f"{SF01}/region.parquet"))
    rows = area_road_topn(flow, areas, 3).filter("area_id = '00'").orderBy("rank").collect()
    assert [(r["road_id"], r["car_count"]) for r in rows] == [("view", 417), ("click", 408), ("purchase", 404)]
    assert rows[0]["area_name"] == "AFRICA"
    plan = area_road_topn(flow, areas, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_follow_car_expected(spark):
    res = follow_car(_flow(spark, SF01), ["U00001", "U00002", "U00003"])
    rows = res.collect()
    assert len(rows) == 211
    for r in rows:
        cars = r["cars"].split(",")
        assert cars == sorted(set(cars)) and r["car_count"] == len(cars)
        assert {"U00001", "U00002", "U00003"} & set(cars)


def test_follow_car_tiny(spark):
    flow = flow_rows(spark, [
        ("T", "2018-07-01 10:01:00", "M1"), ("X", "2018-07-01 10:04:59", "M1"),
        ("Y", "2018-07-01 10:05:00", "M1"), ("Z", "2018-07-01 10:02:00", "M2"),
        ("X", "2018-07-01 10:03:00", "M1")])
    rows = [tuple(r) for r in follow_car(flow, ["T"]).collect()]
    assert rows == [("M1", "2018-07-01 10:00~2018-07-01 10:05", "T,X", 2)]


def test_no_python_udf_in_plans(spark):
    flow = _flow(spark, SF001)
    for df in (topn_monitor(flow, 5), follow_car(flow, ["U00001"]), speed_top10_detail(flow, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan


def test_follow_car_without_targets(spark):
    assert follow_car(_flow(spark, SF001), []).count() == 0


def test_area_names_deterministic(spark):
    flow = flow_rows(spark, [("A", "2018-07-01 10:00:00", "M1", "C1", "50", "r1", "01")])
    areas = spark.createDataFrame([("01", "north"), ("01", "east")], "area_id string, area_name string")
    assert [tuple(r) for r in area_road_topn(flow, areas, 3).collect()] == [("01", "east", "r1", 1, 1)]


def test_follow_car_target_forms_agree(spark):
    flow = _flow(spark, SF001)
    targets = ["U00001", "U00004"]
    want = sorted(map(tuple, follow_car(flow, targets).collect()))
    frame = spark.createDataFrame([(c,) for c in targets], "car string")
    assert sorted(map(tuple, follow_car(flow, frame).collect())) == want


def test_details_hold_every_pass_of_the_counts(spark):
    flow = flow_rows(spark, [("A", "2018-07-01 10:00:00", None), ("B", "2018-07-01 10:00:00", None),
                             ("A", "2018-07-01 10:00:01", "M1"), ("C", None, "M2"), ("C", "2018-07-01 11:00:00", "M2")])
    top = {r["monitor_id"]: r["car_count"] for r in topn_monitor(flow, 5).collect()}
    assert top == {"M1": 1, "M2": 2}
    assert topn_monitor_detail(flow, 5).count() == 3 and topn_monitor_detail(flow, 1).count() == 2
    assert None not in [r["monitor_id"] for r in speed_bands(flow).collect()]
    assert speed_top10_detail(flow, 5).count() == 3
