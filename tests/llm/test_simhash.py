import random
import re

import pytest
import xxhash

from roadlens.llm import simhash
from roadlens.llm.components import components
from tests.llm.conftest import ODD_ROWS


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_match_the_definition():
    rng = random.Random(7)
    texts = ["", " ", "One", "Two words", "É A\x0bB\x1fC d", "the the the the"]
    texts += [" ".join(rng.choice("alpha Beta gamma d é".split()) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_reach_every_near_pair(spark, distance):
    rng = random.Random(distance)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(8):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    classes = spark.createDataFrame([(f, 0) for f in signed], "fp long, first long")
    found = {r.node: r.root for r in components(simhash.links(classes, distance)).collect()}
    expected = brute_components(signed, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= distance)
    assert {n: found.get(n, n) for n in signed} == expected


def test_documents_match_brute_force(make_docs):
    base = " ".join(f"word{i}" for i in range(300))
    rows = ODD_ROWS + [(50 + i, base + f" tail{i % 3}") for i in range(9)] + [(90, base.upper())]
    found = simhash.near_dedup(make_docs(rows, extra="fp component_id")).collect()
    fps = {brute_fingerprint(r[1]) for r in rows}
    roots = brute_components(fps, lambda a, b: bin(a ^ b).count("1") <= 2)
    smallest = {}
    for i, text, *_ in rows:
        root = roots[brute_fingerprint(text)]
        if i is not None:
            smallest[root] = min(i, smallest.get(root, i))
    expected = [(i, f"{brute_fingerprint(t):016x}", smallest.get(roots[brute_fingerprint(t)])) for i, t, *_ in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_one_document_of_each_group_stays(make_docs):
    docs = make_docs(ODD_ROWS, extra="fp root kept")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    roots = brute_components({brute_fingerprint(r[1]) for r in ODD_ROWS}, lambda a, b: bin(a ^ b).count("1") <= 2)
    rows = kept.collect()
    assert len(rows) == len(set(roots.values()))
    assert {r.doc_id for r in rows} >= {1, 2}


def test_empty_table(make_docs):
    assert simhash.near_dedup(make_docs(ODD_ROWS).limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7 + 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
