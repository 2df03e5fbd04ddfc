import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def flow_rows(spark, rows, with_event_id=True):
    """Pass rows from tuples (car, action_time, monitor_id[, camera_id[, speed[, road_id[, area_id]]]])."""
    from roadlens.schema import FLOW_COLUMNS
    out = []
    for i, r in enumerate(rows):
        car, t, mon = r[0], r[1], r[2]
        cam = r[3] if len(r) > 3 else "0" + (mon or "0000")
        speed = r[4] if len(r) > 4 else "50"
        road = r[5] if len(r) > 5 else "1"
        area = r[6] if len(r) > 6 else "01"
        date = t.split(" ")[0] if t else None
        out.append((date, mon, cam, car, t, speed, road, area) + ((i,) if with_event_id else ()))
    cols = FLOW_COLUMNS + (["event_id"] if with_event_id else [])
    schema = ", ".join(f"{c} string" for c in FLOW_COLUMNS) + (", event_id long" if with_event_id else "")
    return spark.createDataFrame(out, schema).select(*cols)
