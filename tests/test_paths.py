"""Many paths in one read, against a plain scan of the tracks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01, flow_rows
from plan_nodes import exchanges
from roadlens.operators.flow import flow_by_date
from roadlens.operators.paths import PathAutomaton, many_path_conversion, many_path_counts
from roadlens.sources.events import read_passes


def brute(tracks, paths):
    out = {}
    for name, path in paths.items():
        for i in range(1, len(path) + 1):
            out[name, i] = sum(t[k:k + i] == path[:i] for t in tracks for k in range(len(t) - i + 1))
    return {(n, i): (c, out.get((n, i - 1))) for (n, i), c in out.items()}


def found(df):
    return {(r.path_id, r.step): (r.cnt, r.prev_cnt) for r in df.collect()}


def tracks_of(flow):
    rows = (flow.groupBy("car").agg(F.sort_array(F.collect_list(F.struct(
        "action_time", "monitor_id", "camera_id", "event_id"))).alias("p")).collect())
    return [[x["monitor_id"] for x in r["p"]] for r in rows]


def random_paths(n, monitors, longest, seed=3):
    rng = random.Random(seed)
    return {f"p{i}": [rng.choice(monitors) for _ in range(rng.randint(1, longest))] for i in range(n)}


def test_a_hundred_paths_and_a_hot_plate(spark):
    flow = flow_by_date(read_passes(spark, SF01))
    flow = flow.withColumn("car", F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("car")))
    paths = random_paths(100, [f"{i:04d}" for i in range(9)], 5)
    assert found(many_path_counts(flow, paths)) == brute(tracks_of(flow), paths)
    # one read, and the hot plate's passes are dealt by slice
    df = many_path_counts(flow, paths)
    assert all("action_time" not in columns or "slice" in columns for _, columns in exchanges(df))


@pytest.mark.parametrize("longest", [1, 2, 7])
def test_equal_times_bad_times_and_other_monitors(spark, longest):
    rng = random.Random(longest)
    rows = []
    for car in ("A", "B", "C", " ", None):
        for _ in range(200):
            time = rng.choice([None, "garbage", "junk", "2024-01-01"] if car == "C" else
                              [f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 30):02d}:{rng.choice([0, 9, 10, 11])}:00"])
            rows.append((car, time, rng.choice(["x", "y", "z", "w", None]), rng.choice(["1", "2"])))
    flow = flow_rows(spark, [(c, t or "", m, cam) for c, t, m, cam in rows]).withColumn(
        "action_time", F.expr("nullif(action_time, '')"))
    from roadlens.operators.sequence import sequence_number
    ordered = sequence_number(flow.filter("trim(car) <> ''")).orderBy("car", "seq").collect()
    tracks = [[r.monitor_id for r in ordered if r.car == car] for car in "ABC"]
    paths = random_paths(30, ["x", "y", "z"], longest) | {"same": ["x"] * longest, "none": ["q"]}
    assert found(many_path_counts(flow, paths)) == brute(tracks, paths)


def test_runs_longer_than_the_longest_path(spark):
    # 50 passes at one place and time are one run; they cross into the next slice too
    rows = [("A", "2024-01-01 10:09:59", "m")] * 50 + [("A", "2024-01-01 10:10:00", "m")] * 3 + [
        ("A", "2024-01-01 10:10:01", "n")]
    paths = {"mm": ["m", "m", "m"], "mn": ["m", "n"], "m4n": ["m"] * 4 + ["n"]}
    assert found(many_path_counts(flow_rows(spark, rows), paths)) == brute([["m"] * 53 + ["n"]], paths)


def test_the_automaton_keeps_the_longest_suffix():
    paths = {"a": list("abab"), "b": list("bab"), "c": list("ab"), "d": list("aba")}
    machine = PathAutomaton(paths)
    assert machine.longest == 4 and len({p[3] for p in machine.prefixes}) == 7
    whole = next(state for name, step, _, state in machine.prefixes if name == "a" and step == 4)
    texts = {state: text for _, _, text, state in machine.prefixes}
    assert {texts[x] for s, x in machine.endings if s == whole} == {"a,b,a,b", "b,a,b", "a,b", "b"}


def test_rates_empty_tables_and_bad_paths(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    paths = {"one": ["0001", "0002", "0003", "0004", "0005"], "two": ["0001", "0002"]}
    rates = sorted((r.path_id, r.step, r.path, r.rate) for r in many_path_conversion(flow, paths).collect())
    assert rates == [("one", 2, "0001,0002", 0.13), ("two", 2, "0001,0002", 0.13)]
    empty = found(many_path_counts(flow.limit(0), paths))
    assert empty["one", 1] == (0, None) and empty["two", 2] == (0, 0) and len(empty) == 7
    with pytest.raises(ValueError):
        many_path_counts(flow, {"x": []})
    with pytest.raises(ValueError):
        many_path_counts(flow, {})
