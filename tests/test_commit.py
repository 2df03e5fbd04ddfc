"""All result tables of a task change together, or none does."""

import os

import pytest
from pyspark.sql import functions as F

from roadlens.session import drop_scratch, materialize, scratch_path
from roadlens.sources.commit import (
    commit_results, committed, drop_superseded, publish, read_committed, recover,
)


def results(spark, value, broken=None, empty=None):
    out = {}
    for name in ("one", "two", "three", "four"):
        df = spark.createDataFrame([(name, value)], "name string, value int")
        if name == broken:  # fails while it is written
            df = df.withColumn("value", F.raise_error(F.lit("no disk")).cast("int"))
        out[name] = df.limit(0) if name == empty else df
    return out


def values(spark, out, tasks=("7",)):
    return {(t, r["task_id"]): r["value"] for t in ("one", "two", "three", "four")
            for r in read_committed(spark, out, t).collect() if r["task_id"] in tasks}


def test_a_failure_in_the_third_table_changes_nothing(spark, tmp_path):
    out = str(tmp_path)
    assert commit_results(spark, results(spark, 1), out, 7) == 1
    assert recover(spark, out) == ["7"]
    with pytest.raises(Exception, match="no disk"):
        commit_results(spark, results(spark, 2, broken="three"), out, 7)
    assert values(spark, out) == {(t, "7"): 1 for t in ("one", "two", "three", "four")}
    assert recover(spark, out) == []  # nothing new to publish
    assert spark.read.parquet(os.path.join(out, "one")).first()["value"] == 1


def test_a_rerun_never_doubles_rows_and_tasks_are_apart(spark, tmp_path):
    out = str(tmp_path)
    commit_results(spark, results(spark, 1), out, 8)
    for value in (1, 2, 3):
        assert commit_results(spark, results(spark, value), out, 7, {"two": "task_id"}) == value
        recover(spark, out)
    assert values(spark, out, ("7", "8")) == {(t, i): v for t in ("one", "two", "three", "four") for i, v in (("7", 3), ("8", 1))}
    assert spark.read.parquet(os.path.join(out, "four")).count() == 2
    assert {r["task_id"]: r["version"] for r in committed(spark, out).collect()} == {"7": 3, "8": 1}
    assert len(drop_superseded(spark, out)) == 2 and drop_superseded(spark, out) == []
    assert values(spark, out)["one", "7"] == 3


def test_a_copy_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    from roadlens.sources import commit
    out, write = str(tmp_path), commit.write_result
    commit_results(spark, results(spark, 1), out, 7)
    publish(spark, out, 7)
    commit_results(spark, results(spark, 2), out, 7)

    def breaks(df, path, *rest, **options):
        if path.endswith("three"):
            raise OSError("lost the store")
        write(df, path, *rest, **options)

    monkeypatch.setattr(commit, "write_result", breaks)
    with pytest.raises(OSError):
        publish(spark, out, 7)
    monkeypatch.undo()
    plain = lambda: [spark.read.parquet(os.path.join(out, t)).first()["value"] for t in ("one", "two", "three", "four")]
    assert plain() == [2, 2, 1, 1] and set(values(spark, out).values()) == {2}
    assert recover(spark, out) == ["7"]
    assert plain() == [2, 2, 2, 2]


def test_an_empty_result_replaces_the_old_rows(spark, tmp_path):
    out = str(tmp_path)
    for empty in (None, "two"):
        commit_results(spark, results(spark, 1, empty=empty), out, 7)
        recover(spark, out)
    assert read_committed(spark, out, "two").count() == 0
    assert not os.path.exists(os.path.join(out, "two", "task_id=7"))


def test_no_commit_yet(spark, tmp_path):
    assert committed(spark, str(tmp_path)).count() == 0
    assert recover(spark, str(tmp_path)) == [] and not publish(spark, str(tmp_path), 7)
    assert read_committed(spark, str(tmp_path), "one", "name string, value int, task_id string").count() == 0
    with pytest.raises(ValueError):
        read_committed(spark, str(tmp_path), "one")


def test_a_task_that_fails_keeps_its_tables(spark, tmp_path):
    from conftest import SF001
    from roadlens.operators.monitor import camera_registry
    from roadlens.plans.tasks import run_task
    from roadlens.sources.events import area_from_region, read_passes
    flow, out = read_passes(spark, SF001), str(tmp_path)
    areas = area_from_region(spark.read.parquet(f"{SF001}/region.parquet"))
    tasks = spark.createDataFrame([(1, '{"startDate":["2024-01-05"],"endDate":["2024-01-05"],"topNum":["5"]}')],
                                  "task_id int, task_param string")
    registry = camera_registry(flow)
    names = run_task(spark, tasks, 1, flow, registry, areas, out)
    before = {n: sorted(map(str, read_committed(spark, out, n).collect())) for n in names}
    # from this day on a camera id cannot be read: only the details fail, after two tables are written
    bad = flow.withColumn("road_id", F.when(F.col("monitor_id") >= "0000", F.raise_error(F.lit("bad sector"))).cast("string"))
    with pytest.raises(Exception, match="bad sector"):
        run_task(spark, tasks, 1, bad, registry, areas, out)
    assert {n: sorted(map(str, read_committed(spark, out, n).collect())) for n in names} == before
    run_task(spark, tasks, 1, flow, registry, areas, out)
    assert {n: sorted(map(str, spark.read.parquet(os.path.join(out, n)).collect())) for n in names}.keys() == before.keys()
    assert {n: sorted(map(str, read_committed(spark, out, n).collect())) for n in names} == before


def test_scratch_tables_can_be_removed(spark):
    drop_scratch(spark)
    path = scratch_path(spark, "never-written")
    table = materialize(spark.range(3), "numbers")
    assert table.count() == 3
    assert drop_scratch(spark) == 1 and not os.path.exists(path)
    assert drop_scratch(spark) == 0
