"""Operator 10: language identification by compression.

Every language has a zstandard raw-content dictionary made of lower-cased
sample texts. A lower-cased text is cut into pieces of ``PIECE`` bytes, each compressed with
every dictionary; the language whose dictionary gives the fewest bytes in all
is chosen. ``score`` is its share under a soft minimum of the sizes per byte;
a narrow margin to the next language sets ``rejected`` (``lang_pred`` then
still names the smallest).

Training sample (bounded, documented): per language at most ``SAMPLES`` texts,
one per hash bucket, the smallest hash among the training texts of at most
``SAMPLE_BYTES`` bytes (longer ones are cut to that only when a bucket has no
other; the first in order of the text where rows repeat an id), joined to a
dictionary of at most ``DICTIONARY_BYTES`` bytes. Every value of ``lang`` is
learned. Only these texts reach the driver; a task holds the compressors of at
most ``AT_ONCE`` languages and goes through further ones in turn.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing was learned; with one language its score is 1;
ties go to the language with more training texts; null ids and nulls in ``lang`` are
never learned from; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import id_bucket, slices
from roadlens.session import materialize

SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES, AT_ONCE = 48, 16_384, 65_536, 200
PIECE, SLICE_BYTES = 4_096, 4 << 20
LEVEL = 6
SHARPNESS = 200.0
MARGIN = 0.01
UNKNOWN = "und"


def learned_from():
    return F.coalesce(id_bucket("doc_id", 5) != 0, F.lit(False))


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """One raw dictionary per learned language, the most frequent language first."""
    rows = (docs.filter(learned_from() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
            .select("doc_id", "lang", F.octet_length("text").alias("size"),
                    F.xxhash64(F.col("doc_id").cast("string")).alias("h")))
    # long texts are taken only where a bucket has no other
    order = F.struct((F.col("size") > SAMPLE_BYTES).alias("long"), F.col("h"), F.col("doc_id"))
    best = (rows.groupBy("lang", F.pmod("h", F.lit(SAMPLES)).alias("bucket"))
            .agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")))
    chosen = materialize(best.select("lang", "bucket", "n", F.col("best.doc_id").alias("doc_id")), "language-sample")
    langs = [r[0] for r in chosen.groupBy("lang").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "lang").collect()]
    # at most SAMPLES ids a language
    texts = (docs.select("doc_id", "lang", F.substring("text", 1, SAMPLE_BYTES).alias("text"))
             .join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"], "left_semi")
             .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    out = {lang: b"" for lang in langs}
    for row in sorted(texts, key=lambda r: (r["lang"], r["doc_id"])):
        out[row["lang"]] = (out[row["lang"]] + b"\n" + row["text"].lower().encode())[-DICTIONARY_BYTES:]
    return out


def _compressor(raw: bytes):
    import zstandard as z

    data = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return z.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_dict_id=False,
                            write_content_size=False).compress


class Classifier:
    def __init__(self, raw: dict[str, bytes], at_once: int = AT_ONCE):
        self.langs = list(raw)
        self.groups = [[raw[lang] for lang in self.langs[i:i + at_once]] for i in range(0, len(raw), at_once)]
        self.kept = [_compressor(x) for x in self.groups[0]] if len(self.groups) == 1 else None

    def rates(self, texts: list[bytes]) -> np.ndarray:
        """Compressed bytes per byte, by text and language."""
        pieces = [[data[i:i + PIECE] for i in range(0, len(data), PIECE)] for data in texts]
        out = []
        for group in self.groups:
            compress = self.kept or [_compressor(x) for x in group]
            out.append([[sum(len(c(p)) for p in own) for c in compress] for own in pieces])
        return np.concatenate([np.array(x, float) for x in out], axis=1) / np.array([[len(t)] for t in texts], float)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))] if self.langs else []
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        if not known:
            return out
        for i, rate in zip(known, self.rates([texts[i].lower().encode() for i in known])):
            best = int(rate.argmin())
            score = 1.0 / float(np.exp(np.maximum(-SHARPNESS * (rate - rate[best]), -700.0)).sum())
            margin = float(np.partition(rate, 1)[1] / rate[best] - 1) if len(rate) > 1 else 1.0
            out[i] = self.langs[best], score, margin < MARGIN
        return out


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every document."""
    raw = dictionaries(docs)

    def run(batches):
        classifier = Classifier(raw)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = classifier.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x[0] for x in found], pa.string()),
                     pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
            .select("doc_id", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                    "lang_pred", "score", "rejected"))
