"""Every registered query against its DuckDB SQL on sf0.001 (the driver's
check runs the same comparison on sf0.01)."""

import duckdb
import pytest

from conftest import SF001
from oracle_compare import TABLES, canon

import __spark_entry__ as E
from roadlens.plans.catalog import QUERIES
from roadlens.plans.oracle import ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert [(r["path"], r["rate"]) for r in rows] == [("0001,0002", 0.13)]


# queries whose output needs only some of the six events columns
PRUNED = {"camera_registry", "path_step_counts", "path_conversion", "car_track", "car_track_blocks",
          "hourly_car_count", "hourly_quota", "sample_cars", "topn_monitor", "topn_monitor_area",
          "speed_rank_monitor", "area_road_topn", "monitor_state", "monitor_camera_state", "follow_car",
          "many_path_counts", "many_path_conversion", "companions", "flow_groupings"}


# queries that write first, with the operators of others
WRITES = {n for n in QUERIES if n.startswith(("task_", "live_", "catalog_"))} | {
    "find_cars", "sketch_cars", "stream_monitor_speed", "load_tsv", "write_result"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_has_no_python_and_prunes_the_scan(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    if name not in PRUNED:
        return
    for line in plan.split("\n"):
        if "FileScan parquet" in line and "events.parquet" in line and "ReadSchema" in line:
            read = line.split("ReadSchema: struct<")[1]
            assert read.count(":") < 6, read


@pytest.mark.parametrize("partitions", [37])
def test_results_do_not_depend_on_partitioning(spark, duck, partitions):
    names = sorted(set(QUERIES) - WRITES)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        for name in names:
            df = QUERIES[name](spark, SF001)
            res = duck.execute(ORACLE_SQL[name])
            got = canon(df.columns, [tuple(r) for r in df.collect()])
            assert got == canon([d[0] for d in res.description], res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def duck_gate():
    from conftest import SF01
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_at_gate_scale(spark, duck_gate, name):
    from conftest import SF01
    df = QUERIES[name](spark, SF01)
    res = duck_gate.execute(ORACLE_SQL[name])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert got == canon([d[0] for d in res.description], res.fetchall())
