from collections import Counter

from pyspark.sql import Window, functions as F

from conftest import SF001, flow_rows
from plan_nodes import exchanges
from roadlens.operators.flow import flow_by_date
from roadlens.operators.sequence import sequence_number
from roadlens.operators.track import car_track, car_track_blocks, path_conversion, path_step_counts
from roadlens.sources.events import read_passes


def _track(spark, ids, car="A1"):
    return flow_rows(spark, [(car, f"2018-07-01 10:{i:02d}:00", m) for i, m in enumerate(ids)])


def counts(df):
    return [r["cnt"] for r in df.orderBy("step").collect()]


def test_overlapping_runs(spark):
    df = _track(spark, ["A", "A", "A", "A"])
    assert counts(path_step_counts(df, ["A", "A", "A"])) == [4, 3, 2]


def test_gap_breaks_the_run(spark):
    df = _track(spark, ["A", "X", "B"])
    assert counts(path_step_counts(df, ["A", "B"])) == [1, 0]
    assert path_conversion(df, ["A", "B"]).count() == 0


def test_whole_id_match(spark):
    df = _track(spark, ["11", "2"])
    assert counts(path_step_counts(df, ["1", "2"])) == [0, 0]


def test_time_ties_use_monitor_then_camera(spark):
    df = flow_rows(spark, [("A1", "2018-07-01 10:00:00", "0002"), ("A1", "2018-07-01 10:00:00", "0001")])
    assert car_track(df).first()["car_track"] == "0001,0002"


def test_hour_overflow_orders_leniently(spark):
    df = flow_rows(spark, [("A1", "2018-07-02 00:30:00", "0002"), ("A1", "2018-07-01 24:10:00", "0001")])
    row = car_track(df).first()
    assert row["car_track"] == "0001,0002"
    assert row["date"] == "2018-07-02"


def test_blank_plates_dropped_and_empty_input(spark):
    df = flow_rows(spark, [("", "2018-07-01 10:00:00", "A"), (None, "2018-07-01 10:01:00", "A"),
                           ("  ", "2018-07-01 10:02:00", "A")])
    assert car_track(df).count() == 0
    assert counts(path_step_counts(df, ["A", "A"])) == [0, 0]
    assert path_conversion(df, ["A", "A"]).count() == 0


def test_sequence_number_equals_plain_row_number(spark):
    # one heavy car over many hours and seconds with ties, plus light cars
    rows = []
    for i in range(600):
        h, m, s = (i * 7) % 30, (i * 13) % 60, (i * 3) % 4
        rows.append(("HOT", f"2018-07-01 {h:02d}:{m:02d}:{s:02d}", f"{i % 9:04d}", f"{i % 5:05d}"))
    for c in range(20):
        rows.append((f"C{c}", f"2018-07-0{1 + c % 3} 10:00:0{c % 10}", f"{c % 9:04d}"))
    df = flow_rows(spark, rows)
    w = Window.partitionBy("car").orderBy(F.expr("cast(action_time as string)"), "monitor_id", "camera_id", "event_id")
    want = sorted(map(tuple, df.select("event_id", F.row_number().over(w).cast("long").alias("seq")).collect()))
    got = sequence_number(df)
    assert got.columns == [*df.columns, "seq"]
    assert sorted(map(tuple, got.select("event_id", "seq").collect())) == want


def test_rows_with_a_null_key_are_numbered(spark):
    df = flow_rows(spark, [(None, "2018-07-01 10:00:00", "0001"), (None, "2018-07-01 09:00:00", "0002"),
                           ("", "2018-07-01 09:00:00", "0003"), ("A", None, "0004"), ("A", "2018-07-01 09:00:00", "0005")])
    got = {(r["car"], r["monitor_id"]): r["seq"] for r in sequence_number(df).collect()}
    assert got == {(None, "0001"): 2, (None, "0002"): 1, ("", "0003"): 1, ("A", "0004"): 1, ("A", "0005"): 2}


def test_paths_longer_than_a_mask(spark):
    track = [f"{i:04d}" for i in range(70)]
    df = _track(spark, track + track[:65])
    assert counts(path_step_counts(df, track)) == [2] * 65 + [1] * 5
    assert path_conversion(df, track).filter("step = 66").first()["rate"] == 0.5


def test_no_window_holds_a_whole_car(spark):
    import re
    flow = flow_by_date(read_passes(spark, SF001))
    plan = car_track_blocks(flow)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_k#\d+, _z#\d+, _t#\d+L", plan)
    assert not re.search(r"hashpartitioning\(car#\d+, \d+\)", plan)
    shuffled = exchanges(path_step_counts(flow, ["0001", "0002"]))
    by_slice = [c for p, c in shuffled if re.match(r"hashpartitioning\(car#\d+, slice#", p)]
    by_car = [c for p, c in shuffled if re.match(r"hashpartitioning\(car#\d+, \d+\)", p)]
    assert by_slice and [set(c) for c in by_car] == [{"car", "slice", "slice_text", "head", "tail"}]  # no passes
    assert len(shuffled) <= 5


def test_two_level_track_assembly(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    one_level = {r["car"]: (r["date"], r["car_track"]) for r in car_track(flow, block=1 << 30).collect()}
    small = {r["car"]: (r["date"], r["car_track"]) for r in car_track(flow, block=3).collect()}
    assert one_level == small


def _substring_count(track, pattern):
    n, i = 0, track.find(pattern)
    while i != -1:
        n += 1
        i = track.find(pattern, i + 1)
    return n


def test_path_counts_match_a_substring_counter(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    path = ["0001", "0002", "0003", "0004", "0005"]
    tracks = [r["car_track"] for r in car_track(flow).collect()]
    want = [sum(_substring_count(t, ",".join(path[:i])) for t in tracks) for i in range(1, 6)]
    assert counts(path_step_counts(flow, path)) == want == [112, 14, 0, 0, 0]
    rates = path_conversion(flow, path).collect()
    assert [(r["path"], r["rate"]) for r in rates] == [("0001,0002", 0.13)]


def test_partition_independence(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    path = ["0000", "0001", "0000"]
    results = []
    for n in (1, 4, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append((counts(path_step_counts(flow, path)),
                        Counter(r["car_track"] for r in car_track(flow).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_track_blocks_are_bounded_and_concatenate(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    blocks = car_track_blocks(flow, block=5).collect()
    assert all(r["last_seq"] - r["first_seq"] + 1 <= 5 for r in blocks)
    assert all(len(r["track_part"].split(",")) == r["last_seq"] - r["first_seq"] + 1 for r in blocks)
    joined = {}
    for r in sorted(blocks, key=lambda r: (r["car"], r["block"])):
        joined[r["car"]] = joined[r["car"]] + "," + r["track_part"] if r["car"] in joined else r["track_part"]
    assert joined == {r["car"]: r["car_track"] for r in car_track(flow).collect()}


def test_worked_example_counts(spark):
    # one car's track and the expected prefix counts, as stated for the path analysis
    track = ["0001", "0002", "0003", "0004", "0001", "0002", "0003", "0001", "0004"]
    df = _track(spark, track)
    assert counts(path_step_counts(df, ["0001", "0002", "0003", "0004", "0005"])) == [3, 2, 2, 1, 0]
    rates = {r["path"]: r["rate"] for r in path_conversion(df, ["0001", "0002", "0003", "0004", "0005"]).collect()}
    assert rates == {"0001,0002": 0.67, "0001,0002,0003": 1.0, "0001,0002,0003,0004": 0.5}
