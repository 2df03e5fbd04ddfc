import numpy as np
import pytest

from roadlens.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, step=50):
    sound = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            sound.setdefault(i, set()).add(tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))
    out = []
    for q, qs in sound.items():
        if q % step:
            continue
        best = {}
        for i, vs in sound.items():
            if i != q:
                scores = [sum(a * b for a, b in zip(x, y)) for x in qs for y in vs if len(x) == len(y)]
                if scores:
                    best[i] = max(scores)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n, i, s) for n, (i, s) in enumerate(ranked, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in rows], SCHEMA).repartition(3)


def clustered(n, d, seed, step=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    x = centres[rng.integers(0, 6, n)] + 0.2 * rng.normal(size=(n, d))
    return [(i * step, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("pivots,block,query_block", [(32, 2048, 8192), (3, 40, 4)])
def test_equals_brute_force(spark, monkeypatch, pivots, block, query_block):
    monkeypatch.setattr(topk_search, "PIVOTS", pivots)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", query_block)
    rows = clustered(500, 8, 1) + [(1000 + i, [0.5] * 8) for i in range(120)]
    found = topk_search.top_k(table(spark, rows)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_copies_in_a_mixed_block():
    rng = np.random.default_rng(7)
    points = rng.integers(-300, 300, size=(90, 6)).astype(float)
    points = np.concatenate([points, np.repeat(points[:5], 12, axis=0), np.repeat([[400.0] * 6], 30, axis=0)])
    ids = rng.permutation(len(points))
    asked = np.array([0, 1, 2, 7, 50, 95, 110, len(points) - 1, len(points) - 9])  # some of them copies
    k, scores = 5, points @ points.T
    r, c, v = topk_search.dual_tree_top_k(ids[asked], points[asked], np.full(len(asked), -np.inf), ids, points, k)
    found = sorted((int(ids[asked[i]]), int(-s), int(ids[j])) for i, j, s in zip(r, c, v))
    expected = [(int(ids[q]), *best) for q in asked
                for best in sorted((-int(scores[q, j]), int(ids[j])) for j in range(len(points)) if j != q)[:k]]
    assert found == sorted(expected)


def test_copies_of_the_query_are_found(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "PIVOTS", 1)  # one block
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -1.0])]
    assert sorted(map(tuple, topk_search.top_k(table(spark, rows)).collect())) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 4, 2, step=10) + [(50, None), (100, []), (None, [1, 2, 3, 4]), (700, [nan, 0, 0, 0]),
                                           (750, [inf, 0, 0, 0]), (800, [None, 1, 1, 1]), (850, [1, 2]), (901, [2, 2]),
                                           (950, [0, 0, 0, 0]), (950, [0, 0, 0, 0]), (951, [1, 0, 0, 0]),
                                           (951, [-3, 0, 0, 1])]
    found = topk_search.top_k(table(spark, rows).withColumnRenamed("label", "score")).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_few_rows(spark):
    assert topk_search.top_k(table(spark, [(0, [1.0]), (1, [2.0])])).collect() == [(0, 1, 1, 131072)]
    assert topk_search.top_k(table(spark, [(0, [1.0])])).count() == 0
    assert topk_search.top_k(table(spark, [(0, [1.0])]).limit(0)).count() == 0


def test_cover_tree_covers_and_separates():
    points = np.rint(np.array([v for _, v in clustered(300, 5, 4)] + [[1.0] * 5] * 90) * 256)
    tree = topk_search.CoverTree(points)
    assert sorted(tree.members(0)) == list(range(len(points)))
    for node, kids in enumerate(tree.kids):
        own = points[tree.members(node)]
        centre = points[tree.centre[node]]
        assert np.sqrt(((own - centre) ** 2).sum(1)).max() <= tree.radius[node] + 1e-3
        if kids:
            assert sorted(p for kid in kids for p in tree.members(kid)) == sorted(tree.members(node))
            kid_points = points[tree.centre[kids]]
            gaps = np.sqrt(((kid_points[:, None] - kid_points[None]) ** 2).sum(2)) + 1e9 * np.eye(len(kids))
            assert gaps.min() > tree.radius[node] / 2 - 1e-3
            assert len(kids) == topk_search.fan_of(len(own)) or tree.radius[kids].max() <= tree.radius[node] / 2 + 1e-3
        else:
            assert len(own) <= topk_search.LEAF or len(own) == 1 or tree.radius[node] <= topk_search.SLACK


def test_clustered_points_are_pruned():
    rng, k = np.random.default_rng(5), 5
    centres = rng.normal(size=(40, 16)) * 300
    points = np.rint(centres[rng.integers(0, 40, 4000)] + 5 * rng.normal(size=(4000, 16)))
    asked, met = np.arange(0, 4000, 20), []
    r, c, v = topk_search.dual_tree_top_k(asked, points[asked], np.full(len(asked), -np.inf), np.arange(4000), points, k, met)
    assert met[0] < 0.25 * len(asked) * len(points)
    scores = points[asked] @ points.T
    scores[np.arange(len(asked)), asked] = -np.inf
    for i in range(len(asked)):
        want = sorted(zip(-scores[i], range(4000)))[:k]
        assert sorted(zip(-v[r == i].astype(float), c[r == i])) == want


def test_memory_of_a_full_block():
    import tracemalloc
    rng = np.random.default_rng(2)
    points = np.rint(rng.normal(size=(700, 64)) * 100)
    queries = np.rint(rng.normal(size=(8192, 64)) * 100)
    queries[:3000] = queries[0]  # copies
    tracemalloc.start()
    topk_search.dual_tree_top_k(np.arange(8192) + 10_000, queries, np.full(8192, -np.inf), np.arange(2048), points, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_more_lengths_than_have_pivots(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "LENGTHS", 2)
    monkeypatch.setattr(topk_search, "BLOCK", 20)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=2 + i % 5).tolist()) for i in range(600)]
    assert sorted(map(tuple, topk_search.top_k(table(spark, rows), step=7).collect())) == brute(rows, step=7)


def expected(ids, points, asked, k):
    """Brute force as sorted (query, -score, id)."""
    out = []
    for q in asked:
        scores = points @ points[q]
        order = np.lexsort((ids, -scores))
        out += [(int(ids[q]), -int(scores[j]), int(ids[j])) for j in order[order != q][:k]]
    return sorted(out)


def test_seconds_without_clusters():
    import time
    rng, k = np.random.default_rng(11), 5
    points = rng.normal(size=(30_000, 64))
    points = np.floor(points / np.linalg.norm(points, axis=1, keepdims=True) * 256)
    ids, asked = rng.permutation(len(points)), np.arange(0, len(points), 50)
    began = time.thread_time()
    r, c, v = topk_search.dual_tree_top_k(ids[asked], points[asked], np.full(len(asked), -np.inf), ids, points, k)
    took = time.thread_time() - began
    assert sorted((int(ids[asked[a]]), -int(s), int(ids[b])) for a, b, s in zip(r, c, v)) == expected(ids, points, asked, k)
    assert took < 150e-9 * len(asked) * len(points)  # a product of matrices takes 2 nanoseconds a pair


@pytest.mark.parametrize("size", [1.0, 300.0, 1e6])
def test_lanes_are_upper_bounds(size):
    rng, k = np.random.default_rng(13), 4
    points = np.rint(size * rng.normal(size=(2500, 24)) * np.linspace(2, 0.05, 24) * rng.uniform(0.01, 1, size=(2500, 1)))
    points[7], points[8:40] = 0, points[41]
    ids, asked = np.arange(len(points)), np.arange(0, len(points), 3)
    scores = points[asked] @ points.T
    floors = -np.sort(-np.where(asked[:, None] == ids[None], -np.inf, scores), axis=1)[:, 60]  # weak, as at the start
    base = topk_search.CoverTree(points, topk_search.WIDE_LEAF).settle(0)
    lanes = topk_search.Lanes([base], points[asked], floors)
    matrix, units, errors, lengths = lanes.queries(points[asked])
    columns, unit, error, length = lanes.points(base)
    found = (matrix @ columns).view(np.int16).reshape(len(asked), -1, 4)[:, :, :3]
    found = np.concatenate([found[:, :, lane] for lane in range(3)], axis=1)[:, :len(points)].astype(float)
    slack = (points[asked] @ base.middle + lengths * error + errors * length + 2 * units * unit)[:, None]
    assert (found * (units * unit)[:, None] + slack >= scores[:, base.order] - 1e-6).all()
    r, c, v = topk_search.dual_tree_top_k(ids[asked], points[asked], floors, ids, points, k)
    assert sorted((int(asked[a]), -int(s), int(b)) for a, b, s in zip(r, c, v)) == expected(ids, points, asked, k)


def test_crowded_pivots_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "PIVOTS", 4)
    monkeypatch.setattr(topk_search, "BLOCK", 30)
    monkeypatch.setattr(topk_search, "TREE", 64)
    monkeypatch.setattr(topk_search, "BATCH", 16)
    rng = np.random.default_rng(17)
    near = rng.normal(size=8)
    rows = [(i, (near + 0.01 * rng.normal(size=8)).tolist()) for i in range(900)] + clustered(100, 8, 5, step=11)
    rows += rows[:40] + [(i, [300.0 * x for x in v]) for i, v in rows[40:60]]  # repeated rows, ids with two vectors, long ones
    found = topk_search.top_k(table(spark, rows), step=20).collect()
    assert sorted(map(tuple, found)) == brute(rows, step=20)
