import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from roadlens.llm import mixing
from tests.llm.conftest import ODD_ROWS


def brute_slots(parts, slots):
    """Earliest deadline first on fractions: (slot, stream, nth, blocks before) of the first slots."""
    size, done, order = sum(parts), [0] * len(parts), []
    for slot in range(slots):
        ready = [(math.ceil(Fraction((done[i] + 1) * size, w)), i) for i, w in enumerate(parts)
                 if w and math.floor(Fraction(done[i] * size, w)) <= slot]
        deadline, i = min(ready)
        assert slot < deadline
        order.append((slot, i, done[i], tuple(done)))
        done[i] += 1
        assert all(abs(n - Fraction(w * (slot + 1), size)) < 1 for n, w in zip(done, parts))
    return order


def spark_slots(spark, sets, slots):
    """The first slots of many schedules at once, by the window expression of the operator."""
    rows = [(i, p, sum(p), [0] * len(p)) for i, p in enumerate(sets)]
    table = spark.createDataFrame(rows, "id int, parts array<long>, size long, none array<long>").repartition(4)
    order = mixing.slot_window(F.col("parts"), F.col("size"), F.col("none"), F.col("none"), slots)
    out = {}
    for r in table.select("id", order.alias("order")).collect():
        out[r["id"]] = [(slot, x["stream"], x["nth"], tuple(x["before"])) for slot, x in enumerate(r["order"])]
    return out


@pytest.mark.parametrize("parts", [[1], [5, 3, 2], [97, 1, 1, 1], [7, 7, 7, 7, 7, 7, 8], [333, 333, 334], [499, 1, 250, 250]])
def test_a_period_is_earliest_deadline_first(spark, parts):
    found = spark_slots(spark, [parts], sum(parts))[0]
    assert found == brute_slots(parts, sum(parts))
    assert [n + (i == found[-1][1]) for i, n in enumerate(found[-1][3])] == parts


def test_random_weights_of_any_period(spark):
    rng = random.Random(5)
    sets = [mixing.exact_parts({str(i): round(rng.random() + 0.06, rng.choice([1, 3, 9, 15])) for i in range(rng.randint(1, 12))},
                               0.05) for _ in range(200)]
    sets.append(mixing.exact_parts(dict(enumerate([1.001, 0.151, 0.005, 0.245, 0.055, 0.096, 0.503, 0.299])), 0.05))
    assert sum(sum(p) > 10 ** 6 for p in sets) > 50
    found = spark_slots(spark, sets, 300)
    for i, parts in enumerate(sets):
        assert found[i] == brute_slots(parts, 300)  # which is below one block at every slot


def test_exact_parts():
    assert mixing.exact_parts({"a": 0.333, "b": 0.667}, 0.05) == [333, 667, 50]
    assert sum(mixing.exact_parts({"a": 0.1234567890123456, "b": 0.7}, 0.05)) > 10 ** 14
    for bad in ({"a": 0.0}, {"a": -1.0}, {"a": 1e-300}):
        with pytest.raises(ValueError):
            mixing.exact_parts(bad, 1.0)


def brute_mix(sizes, parts, block):
    """(stream, block) of every slot: earliest deadline first, begun anew with the others where a stream runs out."""
    left, done, out = [-(-n // block) for n in sizes], [0] * len(sizes), []
    while any(left):
        now = [p if n else 0 for p, n in zip(parts, left)]
        common = math.gcd(*now)
        now, gone, slot = [p // common for p in now], [0] * len(now), 0
        size = sum(now)
        while True:
            i = min((-(-(gone[i] + 1) * size // w), i) for i, w in enumerate(now) if w and gone[i] * size // w <= slot)[1]
            out.append((i, done[i]))
            gone[i], done[i], left[i], slot = gone[i] + 1, done[i] + 1, left[i] - 1, slot + 1
            if not left[i]:
                break
            if slot <= 20_000:
                assert all(abs(n * size - w * slot) < size for n, w in zip(gone, now))
    return out


def check_mix(make_docs, weights, rest, sizes, block, monkeypatch=None):
    names = [*weights, None]
    rows = [(i * 1_000_000 + n, "t", "en", s) for i, (s, size) in enumerate(zip(names, sizes)) for n in range(size)]
    docs = make_docs(rows, extra="__slot __rank")
    placed = mixing.mixed(docs, weights, rest, block)
    assert placed.columns == [*docs.columns, "mix_slot", "mix_position"]
    found = sorted(((r.mix_position, r.mix_slot, r.doc_id) for r in placed.collect()))
    assert [p for p, _, _ in found] == list(range(len(rows)))
    assert Counter(d for _, _, d in found) == Counter(r[0] for r in rows)
    slots = {}
    for _, slot, doc in found:
        slots.setdefault(slot, []).append(doc // 1_000_000)
    expected = brute_mix(sizes, mixing.exact_parts(weights, rest), block)
    assert [slots[s][0] for s in range(len(slots))] == [i for i, _ in expected]
    for s, (i, k) in enumerate(expected):
        assert set(slots[s]) == {i} and len(slots[s]) == min(block, sizes[i] - k * block)


def test_phases_follow_the_weights_that_are_left(make_docs):
    check_mix(make_docs, {"big": 2.0, "small": 1.0}, 1.0, [600, 150, 50], 4)
    check_mix(make_docs, {"a": 1.0, "none": 3.0, "b": 2.0}, 0.001, [40, 0, 95, 33], 3)
    check_mix(make_docs, {"a": 1.0}, 1.0, [1, 0], 16)
    check_mix(make_docs, {"a": 1.0, "b": 1e-12}, 1e-15, [300, 20, 9], 2)  # nothing of b is due while a lasts


@pytest.mark.parametrize("weights,rest,scale", [
    ({f"src{i}": 1.0 + i % 4 for i in range(20)}, 1.0, 2000),  # those of the query: a period of 51
    ({"a": 0.333, "b": 0.667}, 0.05, 20000),
    ({str(i): float(i) for i in range(1, 51)}, 1.0, 1300),
    ({"a": 0.123457, "b": 0.7, "c": 0.1000001, "d": 1e-9}, 0.05, 20000)])  # a period of over 10**8
def test_every_slot_over_many_windows(make_docs, monkeypatch, weights, rest, scale):
    if scale < 20000:
        monkeypatch.setattr(mixing, "WINDOW", 500)
    shares = [Fraction(str(w)) for w in (*weights.values(), rest)]
    check_mix(make_docs, weights, rest, [int(w / sum(shares) * scale) + 1 for w in shares], 1)


def test_a_long_schedule_is_joined_without_a_broadcast(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    check_mix(make_docs, {"a": 0.333, "b": 0.667}, 0.05, [50, 120, 9], 2)


def test_rows_that_repeat_an_id_keep_their_order(make_docs):
    rows = [(7, f"text {i}", "en", "a") for i in range(30)]
    runs = [{r.text: r.mix_position for r in mixing.mixed(make_docs(x), {"a": 1.0}, block=4).collect()}
            for x in (rows, rows[::-1])]
    assert runs[0] == runs[1] and sorted(runs[0].values()) == list(range(30))


def test_odd_rows_and_file_order(spark, make_docs, tmp_path):
    docs = make_docs(ODD_ROWS + [(50 + i, f"t{i}", "en", f"src{i % 3}") for i in range(40)], extra="mix_slot")
    ordered = mixing.in_mixed_order(docs, {"src0": 1.0, "src1": 3.0}, block=2)
    assert ordered.columns == docs.columns
    ordered.write.parquet(str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, written.collect())) == sorted(map(str, docs.collect()))
    expected = [r.doc_id for r in sorted(mixing.mixed(docs.withColumnRenamed("mix_slot", "o"), {"src0": 1.0, "src1": 3.0}, block=2).collect(),
                                         key=lambda r: r.mix_position)]
    by_file = [r.doc_id for f in sorted((tmp_path / "out").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    assert [i for i in by_file if i is not None] == [i for i in expected if i is not None]
    assert mixing.mixed(docs.drop("mix_slot").limit(0), {"src0": 1.0}).count() == 0
