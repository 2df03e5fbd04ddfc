"""Live counts and live path counts on file streams."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from roadlens.operators.flow import flow_by_date
from roadlens.operators.paths import many_path_counts
from roadlens.sources.events import passes_from_events, read_passes
from roadlens.streaming.live_flow import events_stream, start_to_files
from roadlens.streaming.live_paths import live_path_counts
from roadlens.streaming.live_topn import LiveCounts, start_live_counts


def put(spark, base, df, name):
    """Drop a file of events into the watched folder."""
    stage, src = os.path.join(base, "stage", name), os.path.join(base, "in")
    os.makedirs(src, exist_ok=True)
    df.coalesce(1).write.parquet(stage)
    part = next(f for f in os.listdir(stage) if f.endswith(".parquet"))
    os.rename(os.path.join(stage, part), os.path.join(src, f"{name}.parquet"))
    return src


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_live_counts_over_restarts_equal_the_batch(spark, tmp_path):
    base, events = str(tmp_path), spark.read.parquet(f"{SF001}/events.parquet")
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    live = LiveCounts(spark, out)
    assert live.last_batch() is None and live.top(3).count() == 0
    for part in range(3):
        src = put(spark, base, events.filter(F.col("event_id") % 3 == part), f"part{part}")
        start_live_counts(passes_from_events(events_stream(spark, src)), out, ck).awaitTermination()
    want = read_passes(spark, SF001).groupBy("date", "monitor_id").agg(F.count("*").alias("car_count"))
    assert live.last_batch() == 2 and rows(live.counts()) == rows(want)


def test_a_replayed_batch_and_a_broken_one(spark, tmp_path, monkeypatch):
    live, passes = LiveCounts(spark, str(tmp_path)), read_passes(spark, SF001)
    first, second = passes.filter("event_id < 400"), passes.filter("event_id >= 400")
    assert live.add(first, 0)
    before = rows(live.counts())
    assert not live.add(first, 0) and rows(live.counts()) == before
    with pytest.raises(Exception, match="lost"):  # fails while its counts are written
        live.add(second.withColumn("date", F.raise_error(F.lit("lost"))), 1)
    assert rows(live.counts()) == before

    append, broken = spark.createDataFrame, []

    def no_ledger(data, *rest, **options):
        if data == [(1,)] and not broken:
            broken.append(1)
            raise OSError("crash before the ledger")
        return append(data, *rest, **options)

    monkeypatch.setattr(spark, "createDataFrame", no_ledger)
    with pytest.raises(OSError):
        live.add(second, 1)
    assert broken and rows(live.counts()) == before  # its version is there, but not in the ledger
    assert live.add(second, 1) and not live.add(first, 1)
    want = passes.groupBy("date", "monitor_id").agg(F.count("*").alias("car_count"))
    assert rows(live.counts()) == rows(want)
    top = rows(live.top(2))
    assert all(r[1] in (1, 2) for r in top) and len(top) == 2 * want.select("date").distinct().count()


def test_live_paths_with_late_and_repeated_files(spark, tmp_path):
    base, t0, rng = str(tmp_path), dt.datetime(2024, 1, 1, 10), random.Random(4)
    schema = spark.read.parquet(f"{SF001}/events.parquet").schema
    paths = {"a": ["0001", "0002"], "b": ["0001", "0002", "0001"], "c": ["0003"], "d": ["0002", "0002"]}
    # six files of ten minutes each; within a file passes are shuffled, and a tenth comes one file late
    files, late = [[] for _ in range(6)], []
    for i in range(600):
        minute = i // 10
        at = t0 + dt.timedelta(minutes=minute, seconds=rng.randrange(60))
        event = (i, at, rng.randrange(4), "a", 50.0, '{"k": %d}' % rng.choice([1, 2, 3, 5, 10, 11]))
        n = min(minute // 10 + (rng.random() < 0.1), 5)
        files[n].append(event)
    src = out = ck = None
    for n, events in enumerate(files):
        rng.shuffle(events)
        src = put(spark, base, spark.createDataFrame(events, schema), f"f{n}")
        if n == 2:
            put(spark, base, spark.createDataFrame(files[1] + files[2], schema), "again")
        out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
        stream = passes_from_events(events_stream(spark, src))
        start_to_files(live_path_counts(stream, paths, "25 minutes"), out, ck).awaitTermination()
    # far too late: dropped
    put(spark, base, spark.createDataFrame([(9999, t0, 1, "a", 50.0, '{"k": 1}')], schema), "late")
    start_to_files(live_path_counts(passes_from_events(events_stream(spark, src)), paths, "25 minutes"), out, ck).awaitTermination()
    got = {(r.path_id, r.step): r.cnt for r in spark.read.parquet(out).groupBy("path_id", "step").agg(F.sum("cnt").alias("cnt")).collect()}
    every = [e for events in files for e in events]
    mark = max(e[1] for e in every) - dt.timedelta(minutes=25)
    done = spark.createDataFrame([e for e in every if e[1] < mark], schema)
    want = {(r.path_id, r.step): r.cnt for r in many_path_counts(flow_by_date(passes_from_events(done)), paths).collect() if r.cnt}
    assert got == want and len(want) == 8
