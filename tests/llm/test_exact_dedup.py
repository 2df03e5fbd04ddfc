import re
from collections import defaultdict

import pytest

from roadlens.llm import exact_dedup
from tests.llm.conftest import ODD_ROWS


def brute(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(i)
    out = []
    for members in groups.values():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        out += [(rows[i][0], rows[best][0], len(members)) for i in members]
    return sorted(out, key=str)


def test_matches_brute_force_and_keeps_one_row_of_a_group(make_docs):
    rows = ODD_ROWS + [(100 + i, "copy of copies") for i in range(60)] + [(200, "copy of  copies")]
    found = exact_dedup.exact_dedup(make_docs(rows, extra="keep_id text_sha256")).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in found], key=str) == brute(rows)
    by_text = defaultdict(int)
    for r in found:
        by_text[r.text_sha256] += r.kept
    assert set(by_text.values()) == {1}


@pytest.mark.parametrize("buckets,top", [(1, 1), (32, 32)])
def test_both_ways_give_the_same_rows(make_docs, monkeypatch, buckets, top):
    monkeypatch.setattr(exact_dedup, "BUCKETS", buckets)
    monkeypatch.setattr(exact_dedup, "TOP", top)
    rows = [(i, f"text {i % 7}") for i in range(100)]
    found = exact_dedup.exact_dedup(make_docs(rows)).collect()
    assert {(r.doc_id, r.keep_id) for r in found} == {(i, i % 7) for i in range(100)}


def test_documents_that_stay(make_docs):
    docs = make_docs(ODD_ROWS, extra="kept copies")
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len({re.sub(r"\s", "", r[1] or "") for r in ODD_ROWS})
    assert (4, "alpha  beta\ngamma") in rows and (8, " \t\n") in rows


def test_empty_table(make_docs):
    assert exact_dedup.exact_dedup(make_docs(ODD_ROWS).limit(0)).count() == 0
    assert exact_dedup.without_copies(make_docs(ODD_ROWS).limit(0)).count() == 0
