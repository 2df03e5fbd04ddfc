import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, in two partitions."""
    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            docs = docs.selectExpr("*", *[f"'x' AS {c}" for c in extra.split()])
        return docs.repartition(2)
    return make


#: Rows that every operator has to take: nulls, empty texts, copies, repeated rows, a long text.
ODD_ROWS = [(1, "alpha beta gamma"), (2, None), (3, ""), (None, "alpha beta gamma"), (None, None),
            (4, "alpha  beta\ngamma"), (4, "alpha  beta\ngamma"), (5, "a " * 30_000), (6, "\x00 ▁ é́ 你好", None, None),
            (7, "x" * 40_000), (8, " \t\n")]
