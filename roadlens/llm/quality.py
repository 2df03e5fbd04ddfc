"""Operator 1: quality classifier, a regularised quadratic discriminant.

Each whole text becomes a fixed vector of transformed statistics
(``FEATURES``): shares of byte classes under the arcsine square root, lengths
under the logarithm. The fit needs only, per class, the number of rows, the
sums and the sums of products, which Spark adds up over every labelled
training row. A class covariance is shrunk towards the pooled covariance
(``toward_pooled``) and then towards its mean variance on the diagonal
(``toward_diagonal``), and factored once (Cholesky). A score is the logistic
of the difference of the two log densities (squared Mahalanobis distances
from triangular solves, log determinants, log priors).

Defined results: a null text counts as empty; an empty text is a zero vector
and is scored like any other; rows with a null ``doc_id`` are scored and
never learned from; a document whose labels disagree is not learned from;
without rows of both classes every score is 0.5; repeated rows give repeated
results. Only ``doc_id`` and ``text`` are read, so further columns do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import id_bucket, slices, text_bytes, texts
from roadlens.session import materialize

FEATURES = ["log_words", "log_word_bytes", "upper", "symbol", "bang", "pipe", "digit", "stop",
            "stutter"]
SLICE_BYTES = 4 << 20
ACCEPT = 0.7

# byte classes
_OTHER, _SPACE, _LETTER, _UPPER, _DIGIT, _STOP, _BANG, _PIPE, _SYMBOL = range(9)
_CLASS = np.full(256, _OTHER, np.uint8)
for _bytes, _kind in ((b" \t\n\x0b\x0c\r", _SPACE), (bytes(range(97, 123)), _LETTER),
                      (bytes(range(65, 91)), _UPPER), (b"0123456789", _DIGIT),
                      (b".,;:'\"-()", _STOP), (b"!?", _BANG), (b"|", _PIPE),
                      (b"#$%&*@^~<>{}[]\\/=+_`", _SYMBOL), (bytes(range(128, 256)), _LETTER)):
    _CLASS[list(_bytes)] = _kind


def _arcsine(share: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(share, 0.0, 1.0)))


def features(array: pa.StringArray) -> np.ndarray:
    """(rows, len(FEATURES)) statistics of whole texts."""
    data, offsets = text_bytes(array)
    n = len(array)
    out = np.zeros((n, len(FEATURES)))
    kinds = _CLASS[data]
    for i in range(n):
        lo, hi = offsets[i], offsets[i + 1]
        if lo == hi:
            continue
        count = np.bincount(kinds[lo:hi], minlength=9)
        words = data[lo:hi].tobytes().split()
        size, letters = hi - lo - count[_SPACE], count[_LETTER] + count[_UPPER]
        if not words:
            continue
        stutter = sum(map(eq, words, islice(words, 1, None)))  # words equal to the one before
        out[i] = (len(words), size / len(words), count[_UPPER] / max(letters, 1), count[_SYMBOL] / size,
                  count[_BANG] / size, count[_PIPE] / size, count[_DIGIT] / size, count[_STOP] / size,
                  stutter / len(words))
    out[:, :2] = np.log1p(out[:, :2])
    out[:, 2:] = _arcsine(out[:, 2:])
    return out


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, log determinants and log priors."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_priors: list[float]

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        z, factor = (x - self.means[k]).T.copy(), self.factors[k]
        for i in range(len(factor)):  # forward substitution in the cached lower triangle
            z[i] = (z[i] - factor[i, :i] @ z[:i]) / factor[i, i]
        return self.log_priors[k] - 0.5 * (np.einsum("ij,ij->j", z, z) + self.log_dets[k])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        gap = np.clip(self.log_density(x, 1) - self.log_density(x, 0), -500, 500)
        return 1.0 / (1.0 + np.exp(-gap))


def fit_from_sums(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], toward_pooled: float,
                  toward_diagonal: float, floor: float = 1e-4) -> Discriminant:
    """The discriminant from, per class, (rows, sum of x, sum of x xT)."""
    if not all(sums.get(k, (0,))[0] >= 2 for k in (0, 1)):
        return Discriminant([], [], [], [])
    total = sums[0][0] + sums[1][0]
    means = [sums[k][1] / sums[k][0] for k in (0, 1)]
    covs = [sums[k][2] / sums[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(covs[k] * (sums[k][0] / total) for k in (0, 1))
    model = Discriminant(means, [], [], [])
    for k in (0, 1):
        cov = (1 - toward_pooled) * covs[k] + toward_pooled * pooled
        d = len(cov)
        cov = (1 - toward_diagonal) * cov + (toward_diagonal * np.trace(cov) / d + floor) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        model.factors.append(factor)
        model.log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
        model.log_priors.append(float(np.log(sums[k][0] / total)))
    return model


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns of ``FEATURES``, one row per document."""
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)

    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                x = features(texts(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(x[:, j]) for j in range(x.shape[1])]],
                    names=["doc_id", *FEATURES])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def fit(rows: DataFrame, labels: DataFrame, learn_from, toward_pooled: float = 0.5,
        toward_diagonal: float = 0.05) -> Discriminant:
    """Fit on every row of ``rows`` (:func:`document_features`) that has one label and ``learn_from``."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("other"))
             .filter("y = other").select("doc_id", "y"))
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    sums = (rows.filter(learn_from).join(known, "doc_id").groupBy("y")
            .agg(F.count(F.lit(1)), *[F.sum(f) for f in FEATURES],
                 *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs]))
    found = {}
    for row in sums.collect():  # two rows: one per class
        d = len(FEATURES)
        products = np.zeros((d, d))
        for (i, j), value in zip(pairs, row[2 + d:]):
            products[i, j] = products[j, i] = value
        found[int(row[0])] = (float(row[1]), np.array(row[2:2 + d], float), products)
    return fit_from_sums(found, toward_pooled, toward_diagonal)


def not_held_out():
    return F.coalesce(id_bucket("doc_id", 4) != 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    The statistics of all texts are computed once and written to the shared
    folder; the fit and the scores both read that narrow table.
    """
    rows = materialize(document_features(docs), "quality-features")
    model = fit(rows, labels, not_held_out())

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))],
                                             names=["doc_id", "score"])

    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``ACCEPT``, all columns.

    The fit reads narrow statistics; the rows themselves are scored where
    they are read, so no text is shuffled. Where the labels are too few to
    learn from (two rows of each class at least), nothing is rejected.
    """
    model = fit(document_features(docs), labels, not_held_out())
    if not model.means:
        return docs

    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                keep = model.score(features(texts(part))) >= ACCEPT
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
