"""Property tests against independent plain-Python models."""

from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import flow_rows
from roadlens.operators.track import car_track, path_step_counts

IDS = ["0001", "0002", "0003"]

tracks = st.lists(st.lists(st.sampled_from(IDS), min_size=0, max_size=12), min_size=1, max_size=4)
paths = st.lists(st.sampled_from(IDS), min_size=1, max_size=4)


def _count(track: list[str], pattern: list[str]) -> int:
    k = len(pattern)
    return sum(track[i:i + k] == pattern for i in range(len(track) - k + 1))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tracks=tracks, path=paths)
def test_path_counts_equal_run_counting(spark, tracks, path):
    rows = []
    for c, track in enumerate(tracks):
        for i, mon in enumerate(track):
            # several passes share one second to exercise the tie order
            rows.append((f"C{c}", f"2018-07-01 10:{i // 2:02d}:00", mon, f"0{mon}{i:02d}"))
    if not rows:
        return
    df = flow_rows(spark, rows)
    # model order: time, then the documented tie-break (monitor, camera, row id)
    ordered = {}
    for idx, (car, t, mon, cam) in sorted(enumerate(rows), key=lambda e: (e[1][0], e[1][1], e[1][2], e[1][3], e[0])):
        ordered.setdefault(car, []).append(mon)
    want = [sum(_count(t, path[:i]) for t in ordered.values()) for i in range(1, len(path) + 1)]
    got = [r["cnt"] for r in path_step_counts(df, path).orderBy("step").collect()]
    assert got == want
    got_tracks = {r["car"]: r["car_track"] for r in car_track(df, block=2).collect()}
    assert got_tracks == {car: ",".join(t) for car, t in ordered.items()}


passes = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 3), st.integers(0, 30)), min_size=0, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=passes, extract_num=st.integers(0, 80), seed=st.integers(0, 5))
def test_sampling_equals_brute_force(spark, rows, extract_num, seed):
    from test_sample import _brute_force
    from roadlens.operators.sample import hourly_quota, sample_cars
    data = [(f"C{car:02d}", f"2018-07-0{day} {hour:02d}:00:00", "0001") for car, day, hour in rows]
    if not data:
        return
    df = flow_rows(spark, data)
    got = {tuple(r) for r in sample_cars(df, extract_num, seed).collect()}
    plain = [{"car": c, "action_time": t} for c, t, _ in data]
    assert got == _brute_force(plain, extract_num, seed)
    quota = {r["date_hour"]: r["quota"] for r in hourly_quota(df, extract_num).collect()}
    per_hour = {}
    for _, dh, _ in got:
        per_hour[dh] = per_hour.get(dh, 0) + 1
    assert all(per_hour.get(h, 0) == q for h, q in quota.items())
