import itertools
import re
from collections import defaultdict

import pytest

from roadlens.llm import filter_audit as op
from tests.llm.conftest import ODD_ROWS


def fails(rows, i):
    doc_id, text = rows[i][0], rows[i][1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 100 else ""
    out += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    copies = [r[0] for r in rows if (r[1] or "") == text and r[0] is not None]
    return out + ("E" if doc_id is not None and min(copies) < doc_id else "")


def brute(rows, labels):
    parts = defaultdict(list)
    for i, r in enumerate(rows):
        lang = r[2] if len(r) > 2 else "en"
        own = [x for x in labels if x[0] == r[0] and r[0] is not None]
        parts[lang or ""].append((fails(rows, i), any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part, docs in parts.items():
        removed = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed[order, step] = (len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                                        sum(d[0] == f for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
        for (order, step), x in removed.items():
            f = order[step - 1]
            out.append((part, order, step, f, *x, sum(y[1] for (o, s), y in removed.items() if o[s - 1] == f)))
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(120))
ROWS = ODD_ROWS + [(10, LONG), (11, LONG), (12, LONG, "de"), (None, LONG), (13, LONG.upper(), "de"), (14, LONG + " #", None),
                   (15, "W " * 150, "fr"), (16, "W " * 150, "fr"), (16, "W " * 150, "fr"), (9, LONG + " #", "de"),
                   (17, "\x85x\xa0y " * 60), (18, "ÀÉ" * 50), (19, "A" + "é" * 9), (30, "A" + "é" * 8)]
LABELS = [(10, 1, 0), (11, 1, 1), (12, 0, 1), (13, None, 1), (13, 1, None), (15, 1, 0), (16, 0, 0), (16, 1, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture
def make_labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part")


def test_equals_brute_force_on_odd_rows(make_docs, make_labels):
    docs = make_docs(ROWS, extra="part mask n good")
    found = sorted(map(tuple, op.filter_audit(docs, make_labels(LABELS)).collect()))
    assert found == brute(ROWS, LABELS)


def test_empty_tables(make_docs, make_labels):
    assert op.filter_audit(make_docs(ROWS).limit(0), make_labels(LABELS)).count() == 0
    found = sorted(map(tuple, op.filter_audit(make_docs(ROWS), make_labels(LABELS).limit(0)).collect()))
    assert found == brute(ROWS, [])


@pytest.mark.parametrize("k", [1, 3, 5])
def test_intervals_name_every_removal_once(k):
    orders = list(itertools.permutations(range(k)))
    covered = defaultdict(set)
    for mask, step, low, high in op.intervals(k):
        for rank in range(low, high):
            assert step not in covered[mask, rank]
            covered[mask, rank].add(step)
    for mask in range(1, 1 << k):
        for rank, order in enumerate(orders):
            first = min(i for i, f in enumerate(order, 1) if mask >> f & 1)
            assert covered[mask, rank] == {first}
