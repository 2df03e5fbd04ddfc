import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadlens.llm import quality
from tests.conftest import SF01
from tests.llm.conftest import ODD_ROWS


def test_features_of_odd_texts():
    x = quality.features(pa.array(["", " \n", "AB ab!", "a a a b", "|| 1"]))
    assert not x[:2].any()
    name = dict(zip(quality.FEATURES, x.T))
    assert name["upper"][2] == pytest.approx(np.arcsin(np.sqrt(0.5)))
    assert name["stutter"][3] == pytest.approx(np.arcsin(np.sqrt(0.5)))
    assert name["pipe"][4] > 0 and name["digit"][4] > 0


def test_score_equals_the_dense_formula():
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(400, 3)), rng.normal(size=(300, 3)) @ np.diag([1, 2, 0.5]) + 1]
    sums = {k: (len(x[k]), x[k].sum(0), x[k].T @ x[k]) for k in (0, 1)}
    model = quality.fit_from_sums(sums, toward_pooled=0.3, toward_diagonal=0.1, floor=0.0)
    covs = [np.cov(v.T, bias=True) for v in x]
    pooled = (400 * covs[0] + 300 * covs[1]) / 700
    q = rng.normal(size=(5, 3))
    logs = []
    for k in (0, 1):
        c = 0.7 * covs[k] + 0.3 * pooled
        c = 0.9 * c + 0.1 * np.trace(c) / 3 * np.eye(3)
        d = q - x[k].mean(0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) + np.linalg.slogdet(c)[1])
                    + np.log(len(x[k]) / 700))
    assert np.allclose(model.score(q), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_held_out_accuracy_and_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    scored = quality.quality_scores(docs, labels)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert scored.count() == docs.count() and len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    clean = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in clean]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == \
        {r.doc_id for r in scored.filter("predicted = 1").collect()}


def test_odd_rows_and_no_labels(spark, make_docs):
    docs = make_docs(ODD_ROWS, extra="score upper")
    none = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs, none).collect()
    assert len(rows) == len(ODD_ROWS) and all(r.score == 0.5 and r.predicted == 0 for r in rows)
    assert quality.quality_scores(docs.limit(0), none).count() == 0


def test_labels_that_disagree_are_not_learned_from(spark, make_docs):
    docs = make_docs([(i, "good words here" if i % 2 else "BAD!! ### $$$") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(i, 1 - i % 2, 0) for i in range(40)],
                                   "doc_id long, quality int, toxic int")
    assert quality.quality_scores(docs, labels).select(F.max("score")).first()[0] == 0.5


def test_without_labels_to_learn_from_nothing_is_rejected(spark, make_docs):
    docs = make_docs(ODD_ROWS, extra="score")
    for labels in ([], [(1, 1, 0), (2, 0, 0)], [(1, None, None)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        kept = quality.accepted(docs, table)
        assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
