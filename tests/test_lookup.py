from pyspark.sql import functions as F

from conftest import SF01, flow_rows
from roadlens.sources.events import read_passes
from roadlens.sources.lookup import find_cars, save_lookup_table


def rows_read(df):
    """Rows that the scans of a collected DataFrame handed on, after whole row groups were left out."""
    n, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            n += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_row_groups_without_the_plates_are_not_read(spark, tmp_path):
    # 30 days, 400 cars a day, in row groups of a few hundred rows
    flow = read_passes(spark, SF01)
    many = flow.crossJoin(spark.range(20)).withColumn("car", F.concat("car", F.lit("-"), "id")).drop("id", "event_id")
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    many.repartition(4).write.partitionBy("date").parquet(plain)
    save_lookup_table(many, laid, row_group_bytes=16 << 10, cars_per_group=500)
    cars = ["U00003-4", "U00077-19"]
    found = find_cars(spark, laid, cars)
    got = sorted(map(str, found.collect()))
    want = many.filter(F.col("car").isin(cars)).select(*found.columns)
    assert got and got == sorted(map(str, want.collect()))
    before = find_cars(spark, plain, cars)
    before.collect()
    assert rows_read(before) > many.count() / 2 and rows_read(found) < many.count() / 10
    # a plate that lies between those of every row group is known to none: the Bloom filters say so
    absent = find_cars(spark, laid, ["U00050-4x"])
    assert absent.collect() == [] and rows_read(absent) < many.count() / 20


def test_dates_and_odd_lists(spark, tmp_path):
    flow = flow_rows(spark, [("A", "2024-01-01 10:00:00", "m"), ("A", "2024-01-03 10:00:00", "m"), ("B", "2024-01-01 11:00:00", "m"),
                             (None, "2024-01-01 11:00:00", "m")])
    path = str(tmp_path / "t")
    save_lookup_table(flow, path)
    assert find_cars(spark, path, ["A", "A", "nobody"]).count() == 2
    assert [r.action_time for r in find_cars(spark, path, ["A"], "2024-01-02", "2024-01-03").collect()] == ["2024-01-03 10:00:00"]
    assert find_cars(spark, path, []).count() == 0
    save_lookup_table(flow.filter("date > '2024-01-02'"), path)  # a load replaces the table
    assert find_cars(spark, path, ["A", "B"]).count() == 1
