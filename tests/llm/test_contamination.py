import hashlib
import math
import re

import pytest

from roadlens.llm import contamination as op
from tests.llm.conftest import ODD_ROWS

LOWER = str.maketrans({c: chr(ord(c) + 32) for c in map(chr, range(65, 91))})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, size=10, shingle=3, least=1.0):
    windows = {(i, tuple(w[s:s + size])) for i, t in items for w in [words(t)] if w for s in range(max(len(w) - size, 0) + 1)}
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for item, window in windows:
            n = len(window)
            k = min(shingle, n)
            for s in range(len(w) - n + 1):
                same = [a == b for a, b in zip(w[s:s + n], window)]
                shared = sum(all(same[i:i + k]) for i in range(n - k + 1))
                if shared >= math.ceil((n - k + 1) * least - 1e-9):
                    hit |= set(range(s, s + n))
                    ids.add(item)
        ids = sorted(str(i) for i in ids - {None})
        out.append((r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


PASSAGE = "One two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, PASSAGE), (2, "alpha BETA"), (3, PASSAGE.replace(" ", "--")), (4, None), (5, "?! ."), (None, "kappa lambda"),
         (6, "ζήτα x9 ЖЖ"), (2, "omega"), (7, "a a a a a a a a a a a")]
ROWS = ODD_ROWS + [
    (20, "zero one Two three, four five six seven eight nine ten zero"),
    (21, "two three four five six seven eight nine ten eleven twelve; one two three four five six seven eight nine"),
    (22, "alpha  beta alpha gamma"), (23, "beta alpha"), (24, "omega kappa lambda"), (25, "Ζήτα X9 ЖЖ ζήτα x9 жж"),
    (25, "ζήτα x9 ЖЖ"), (26, PASSAGE + " filler " + PASSAGE), (27, "a a a a a a a a a a b a a a a a a a a a a a a"),
    (28, "one two three four five six seven eight nine"), (29, "three four five SIX x eight nine ten eleven twelve thirteen")]


@pytest.fixture
def make_items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS words", "'y' AS doc_id")
    return make


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force_on_odd_rows(make_docs, make_items):
    docs = make_docs(ROWS, extra="words at item_id window")
    assert found(op.contamination(docs, make_items(ITEMS))) == brute(ROWS, ITEMS)


@pytest.mark.parametrize("size,shingle,least,block", [(10, 3, 0.5, 200_000), (5, 1, 0.6, 200_000), (10, 3, 1.0, 4), (4, 2, 0.3, 5)])
def test_partial_containment_and_small_blocks(make_docs, make_items, size, shingle, least, block):
    rows = [r for r in ROWS if len(r[1] or "") < 1000]
    hits = op.benchmark_hits(make_docs(rows), make_items(ITEMS), size, shingle, least, block)
    got = sorted(((r.doc_id, r.n_words, len({w for s in r.spans for w in range(s.first, s.last + 1)}), len(r.item_ids),
                   hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), bool(r.spans)) for r in hits.collect()), key=str)
    assert got == brute(rows, ITEMS, size, shingle, least)


def test_empty_tables(make_docs, make_items):
    docs, items = make_docs(ROWS), make_items(ITEMS)
    assert op.contamination(docs.limit(0), items).count() == 0
    assert found(op.contamination(docs, items.limit(0))) == brute(ROWS, [])


def test_no_python_in_the_plan(make_docs, make_items):
    plan = op.contamination(make_docs(ROWS), make_items(ITEMS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
