"""Operator 7: token counts, with overlap resynchronisation for huge documents.

Texts of at most ``chunk`` characters are counted whole where they are read: the
stable boundaries described below part them into words, and a task encodes
each distinct word once and adds up.
A longer text is cut into chunks that overlap by ``overlap`` characters; the
chunks are rows of their own, dealt over all tasks, so no task encodes a huge
document alone. Two neighbours are spliced at a common boundary inside their
overlap: a place where white space ends, and where a token begins in both
encodings. Such a boundary is stable: the tokenizer drops white space before
it merges, and neither its normaliser nor its word pattern reaches across, so
what stands left of it cannot change the tokens right of it, and the other
way round. Each chunk counts its tokens between its two boundaries.

A document whose neighbours find no common boundary (an overlap without white
space, say) is cut anew with chunks and overlaps four times as wide, until
every document is whole; at the latest one chunk holds it.

Defined results: a null text counts as empty and has 0 tokens; null ids and
repeated rows are counted like any other row; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import os
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import slices, text_key, texts
from roadlens.session import materialize

CHUNK, OVERLAP, WIDEN = 16_384, 512, 4
TOKEN_LIMIT = 2048
KEPT_WORDS = 500_000  # distinct words a task remembers
SLICE_BYTES = 2 << 20
SPACE = " \t\n\r"


def load(vocabulary: str):
    """The tokenizer of a ``tokenizers`` JSON text; special strings inside texts as its default."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    probe = "ab cd\nef"
    if any(set(SPACE) & set(probe[a:b]) for a, b in tokenizer.encode(probe, add_special_tokens=False).offsets):
        raise ValueError("only tokenizers that drop white space have stable boundaries after it")
    return tokenizer


def boundary(encoding, text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """The first stable boundary in ``text[lo:hi]``: (place, index of the token that begins there)."""
    for p in range(lo + 1, hi):
        if text[p - 1] in SPACE and text[p] not in SPACE:
            token = encoding.char_to_token(p)
            if token is not None and encoding.token_to_chars(token)[0] == p:
                return p, token
    return None


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(start, chunk) pieces that overlap by ``overlap`` characters and cover ``text``."""
    step = chunk - overlap
    return [(at, text[at:at + chunk]) for at in range(0, max(len(text) - overlap, 1), step)]


def _counts_of_whole_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    def run(batches):
        tokenizer, known = load(vocabulary), {}
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                if len(known) > KEPT_WORDS:
                    known.clear()
                split = [t.split() for t in texts(part).cast(pa.binary()).to_pylist()]  # at ASCII white space
                new = {w for words in split for w in words}.difference(known)
                new = list(new)
                found = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
                known.update(zip(new, map(len, found)))
                count = known.__getitem__
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"),
                     pa.array([sum(map(count, words)) for words in split], pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


_KEYS = ["row_no", "doc_id", "text_key", "n_bytes"]


def _spliced(docs: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """Per long document: ``doc_id, text_key, n_bytes, n_tokens, whole`` (every splice agreed)."""
    chunks_schema = "row_no long, doc_id long, text_key long, n_bytes long, chunk_no long, last boolean, start long, text string"

    def split(batches):
        for batch in batches:
            columns = [batch.column(k) for k in _KEYS]
            for i, text in enumerate(texts(batch)):
                pieces = cut(text.as_py(), chunk, overlap)
                for at in range(0, len(pieces), 64):
                    part = pieces[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c[i].as_py()] * len(part), pa.int64()) for c in columns]
                        + [pa.array(range(at, at + len(part)), pa.int64()),
                           pa.array([at + j == len(pieces) - 1 for j in range(len(part))]),
                           pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.string())],
                        names=[*_KEYS, "chunk_no", "last", "start", "text"])

    def encode(batches):
        tokenizer = load(vocabulary)
        for batch in batches:
            lefts, rights, counts = [], [], []
            for text, no, last, start in zip(texts(batch).to_pylist(), batch.column("chunk_no").to_pylist(),
                                             batch.column("last").to_pylist(), batch.column("start").to_pylist()):
                encoding = tokenizer.encode(text, add_special_tokens=False)
                left = (0, 0) if no == 0 else boundary(encoding, text, 0, overlap)
                right = ((len(text), len(encoding.ids)) if last
                         else boundary(encoding, text, len(text) - overlap, len(text)))
                found = left is not None and right is not None
                lefts.append(start + left[0] if found else None)
                rights.append(start + right[0] if found else None)
                counts.append(right[1] - left[1] if found else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in _KEYS], batch.column("chunk_no"), batch.column("last"),
                 *[pa.array(x, pa.int64()) for x in (lefts, rights, counts)]],
                names=[*_KEYS, "chunk_no", "last", "left_at", "right_at", "n"])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = (docs.withColumn("row_no", F.monotonically_increasing_id())
             .mapInArrow(split, chunks_schema).repartition(tasks, "row_no", "chunk_no")
             .mapInArrow(encode, ", ".join(f"{k} long" for k in _KEYS)
                         + ", chunk_no long, last boolean, left_at long, right_at long, n long"))
    # each splice is signed from both sides; the signatures cancel out where they agree
    number = F.col("chunk_no")
    left = F.when(number > 0, F.xxhash64(number, "left_at")).otherwise(0)
    right = F.when(~F.col("last"), F.xxhash64(number + 1, "right_at")).otherwise(0)
    return (parts.groupBy(*_KEYS)
            .agg(F.sum("n").alias("n_tokens"),
                 (F.bool_and(F.col("n").isNotNull() & (F.col("n") >= 0))
                  & (F.bit_xor(left.bitwiseXOR(right)) == 0)).alias("whole"))
            .drop("row_no"))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = TOKEN_LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document.

    ``vocabulary`` is the JSON text of a ``tokenizers`` file.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    long = F.char_length("text") > chunk
    pending = rows.filter(long).withColumn("text_key", text_key())
    done = [_counts_of_whole_texts(rows.filter(~long), vocabulary)]
    while True:
        found = materialize(_spliced(pending, vocabulary, chunk, overlap), "token-counts")
        done.append(found.filter("whole").select("doc_id", "n_bytes", "n_tokens"))
        failed = found.filter("NOT whole").select("doc_id", "text_key").distinct()
        if failed.isEmpty():
            break
        same = (pending["doc_id"].eqNullSafe(failed["doc_id"])) & (pending["text_key"] == failed["text_key"])
        pending = pending.join(failed, same, "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    return (reduce(DataFrame.unionByName, done)
            .withColumn("over_limit", F.col("n_tokens") > limit))
