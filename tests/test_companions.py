import pytest

from conftest import flow_rows
from roadlens.operators.companions import companions

ROWS = [("T", "2024-01-01 10:00:00", "m1"), ("T", "2024-01-01 10:00:00", "m1", "other camera"), ("T", "2024-01-01 10:09:58", "m1"),
        ("T", "2024-01-01 24:00:30", "m2"), ("A", "2024-01-01 09:58:00", "m1"), ("A", "2024-01-01 10:02:00", "m1"),
        ("A", "2024-01-01 10:11:59", "m1"), ("B", "2024-01-01 10:02:01", "m1"), ("B", "2024-01-02 00:00:00", "m2"),
        ("C", "2024-01-01 10:00:00", "m3"), ("C", "garbage", "m1"), ("T", "garbage", "m1"), (None, "2024-01-01 10:00:00", "m1"),
        ("D", "2024-01-01 10:00:00", None), ("U", "2024-01-01 10:00:05", "m1")]


def seconds(text):
    day, clock = text.split(" ")
    h, m, s = map(int, clock.split(":"))
    return int(day[-2:]) * 86400 + h * 3600 + m * 60 + s


def brute(targets, span):
    good = {(r[0], r[2], seconds(r[1])) for r in ROWS if r[0] and r[2] and r[1] != "garbage"}
    out = {}
    for t, place, at in good:
        if t in targets:
            for c in {c for c, p, _ in good if p == place and c != t}:
                gaps = [abs(x - at) for d, p, x in good if d == c and p == place and abs(x - at) <= span]
                if gaps:
                    out.setdefault((t, c), []).append(min(gaps))
    return sorted((t, c, len(g), min(g)) for (t, c), g in out.items())


@pytest.mark.parametrize("targets,span", [(["T"], 120), (["T", "U", "T"], 119), (["T"], 0), (["A", "B"], 7200), (["nobody"], 60), ([], 60)])
def test_equals_brute_force(spark, targets, span):
    found = sorted(map(tuple, companions(flow_rows(spark, ROWS), targets, span).collect()))
    assert found == brute(targets, span)


def test_neither_pairs_of_a_busy_monitor_nor_a_cross_join(spark):
    # 3,000 passes of 300 cars at one monitor in a day; the plan joins by monitor and bin
    rows = [(f"C{i % 300}", f"2024-01-01 {i // 125:02d}:{i % 60:02d}:{i % 59:02d}", "m") for i in range(3000)]
    df = companions(flow_rows(spark, rows), ["C7"], 30)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    met = sum(r.meetings for r in df.collect())
    assert 0 < met < 300
    with pytest.raises(ValueError):
        companions(df, [], -1)
