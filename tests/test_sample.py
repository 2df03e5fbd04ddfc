import hashlib
from collections import defaultdict

from conftest import SF001, SF01, flow_rows
from roadlens.operators.flow import flow_by_date
from roadlens.operators.sample import (
    hourly_car_count, hourly_quota, sample_cars, sample_detail, sample_track,
)
from roadlens.sources.events import read_passes


def _hour_rows(spark, hour, n_cars, day="2018-07-01"):
    return [(f"C{i:04d}", f"{day} {hour}:00:00", "0001") for i in range(n_cars)]


def test_quota_truncates_in_doubles(spark):
    # 29 of 100 cars of the day in one hour, extract 100: 29/100*100 is 28.999... -> 28
    rows = _hour_rows(spark, "05", 29) + [(f"D{i:04d}", "2018-07-01 06:00:00", "0001") for i in range(71)]
    q = {r["date_hour"]: r["quota"] for r in hourly_quota(flow_rows(spark, rows), 100).collect()}
    assert q["2018-07-01_05"] == 28


def test_quota_capped_at_hour_cars(spark):
    q = hourly_quota(flow_rows(spark, _hour_rows(spark, "03", 3)), 100).first()
    assert (q["cars"], q["quota"]) == (3, 3)


def test_empty_range_gives_no_rows(spark):
    flow = flow_by_date(read_passes(spark, SF001), "1999-01-01", "1999-01-02")
    assert hourly_quota(flow, 100).count() == 0
    assert sample_cars(flow, 100).count() == 0


def _brute_force(flow_rows_list, extract_num, seed):
    hours = defaultdict(set)
    for r in flow_rows_list:
        if r["car"] and r["car"].strip():
            day, clock = r["action_time"].split(" ")
            hours[(day, f"{day}_{clock.split(':')[0]}")].add(r["car"])
    days = {d for d, _ in hours}
    per_day = extract_num // len(days) if days else 0
    day_cars = defaultdict(int)
    for (d, _), cars in hours.items():
        day_cars[d] += len(cars)
    picked = set()
    for (d, dh), cars in hours.items():
        quota = min(len(cars), int(len(cars) / day_cars[d] * per_day))
        order = sorted(cars, key=lambda c: (hashlib.md5(f"{c}|{dh}|{seed}".encode()).hexdigest(), c))
        picked |= {(d, dh, c) for c in order[:quota]}
    return picked


def test_sample_matches_brute_force(spark):
    flow = flow_by_date(read_passes(spark, SF01))
    rows = flow.select("car", "action_time").collect()
    for extract_num in (600, 3000, 100000):
        got = {tuple(r) for r in sample_cars(flow, extract_num, 7).collect()}
        assert got == _brute_force(rows, extract_num, 7)


def test_sample_properties_and_partition_independence(spark):
    flow = flow_by_date(read_passes(spark, SF01))
    quota = {r["date_hour"]: r["quota"] for r in hourly_quota(flow, 3000).collect()}
    results = []
    for n in (1, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(map(tuple, sample_cars(flow, 3000, 42).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
    picked = results[0]
    assert len(picked) == len(set(picked)) == 2658
    per_hour = defaultdict(int)
    for _, dh, _ in picked:
        per_hour[dh] += 1
    assert all(per_hour[h] == q for h, q in quota.items() if q > 0)


def test_detail_and_track_cover_whole_range(spark):
    flow = flow_by_date(read_passes(spark, SF001))
    picked = sample_cars(flow, 3000, 42)
    cars = {r["car"] for r in picked.collect()}
    detail = sample_detail(flow, picked)
    assert {r["car"] for r in detail.select("car").distinct().collect()} == cars
    assert detail.count() == flow.filter(flow.car.isin(list(cars))).count()
    assert sample_track(flow, picked).count() == len(cars)
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_hourly_counts(spark):
    flow = flow_by_date(read_passes(spark, SF01))
    rows = hourly_car_count(flow).collect()
    assert len(rows) == 720 and sum(r["cars"] for r in rows) > 0


def test_bad_times_belong_to_no_hour_and_no_day(spark):
    good = [(f"C{i:03d}", "2018-07-01 10:00:00") for i in range(100)]
    bad = [(f"N{i:03d}", t) for i, t in enumerate([None, "", "garbage", "2018-07-02", "2018-07-01 1x:00:00"] * 100)]
    flow = flow_rows(spark, [(c, t, "0001") for c, t in good + bad])
    picked = sample_cars(flow, 10, 42).collect()
    assert len(picked) == 10 and {r["date_hour"] for r in picked} == {"2018-07-01_10"}
    assert [(r["cars"], r["quota"]) for r in hourly_quota(flow, 10).collect()] == [(100, 10)]
    assert {tuple(r) for r in picked} == _brute_force([{"car": c, "action_time": t} for c, t in good], 10, 42)
