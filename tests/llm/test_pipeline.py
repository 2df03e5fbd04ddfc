import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from roadlens.llm import exact_dedup, mixing, quality, simhash
from roadlens.llm.queries import ORACLE_SQL, QUERIES, REST_WEIGHT, SOURCE_WEIGHTS
from tests.conftest import SF01
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_over_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, steps = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, SF01).write.parquet(path)
        docs = spark.read.parquet(path)
        steps.append(docs)
    assert all(d.columns == columns for d in steps[:-1])
    rows = [{r.doc_id: r for r in d.collect()} for d in steps]
    assert all(len(r) == d.count() for r, d in zip(rows, steps))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    clean = [i for i in source if labels.get(i) == 1]
    assert len([i for i in clean if i in rows[0]]) > 0.98 * len(clean)
    assert len([i for i in source if labels.get(i) == 0 and i in rows[0]]) < 0.1 * len(labels)
    # one of each text, the longest and then the smallest id
    groups = {}
    for i, r in rows[0].items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), []).append(i)
    assert set(rows[1]) == {min(g, key=lambda i: (-len(rows[0][i].text), i)) for g in groups.values()}
    # one of each component, the smallest id
    fps = {i: brute_fingerprint(r.text) for i, r in rows[1].items()}
    roots = brute_components(set(fps.values()), lambda a, b: bin(a ^ b).count("1") <= 2)
    kept = {}
    for i, f in fps.items():
        kept[roots[f]] = min(i, kept.get(roots[f], i))
    assert set(rows[2]) == set(kept.values())
    # the same rows in another order
    assert Counter(rows[2].values()) == Counter(rows[3].values())
    assert set(rows[4]) == set(rows[3]) and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows[4].values())


def test_tokens_follow_the_mix(spark, make_docs, tmp_path):
    # files of very different sizes, which Spark does not read by name; ids that repeat or are null
    rows = [(i if i % 50 else None, f"text {i} " + "long " * (i % 7 * (i % 31)), "en", f"src{i % 3}") for i in range(200)]
    docs = make_docs(rows + rows[-3:], extra="mix_position")
    corpus_pipeline.mixing_stage(spark, docs, SF01).write.option("maxRecordsPerFile", 7).parquet(str(tmp_path / "mix"))
    mix = spark.read.parquet(str(tmp_path / "mix"))
    corpus_pipeline.token_stage(spark, mix, SF01).write.parquet(str(tmp_path / "tokens"))
    placed = mixing.mixed(docs.withColumnRenamed("mix_position", "o"), SOURCE_WEIGHTS, REST_WEIGHT).collect()
    written = [r for f in sorted((tmp_path / "tokens").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    assert [(r.doc_id, r.source) for r in written] == [(r.doc_id, r.source) for r in
                                                       sorted(placed, key=lambda r: r.mix_position)]
    assert [r.mix_position for r in written] == list(range(len(rows) + 3))
    corpus_pipeline.mixing_stage(spark, docs.limit(0), SF01).write.parquet(str(tmp_path / "none"))
    assert corpus_pipeline.token_stage(spark, spark.read.parquet(str(tmp_path / "none")), SF01).count() == 0


def test_registered():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(ORACLE_SQL) <= set(QUERIES)
    assert [f.__module__ for f in (quality.accepted, exact_dedup.without_copies, simhash.one_of_each)] == [
        "roadlens.llm.quality", "roadlens.llm.exact_dedup", "roadlens.llm.simhash"]
