"""Operator 9: an interpolated modified Kneser-Ney n-gram model.

Tokens are lower-cased (A-Z) words and one end per text; an n-gram is known by
a 64-bit hash of its words. Spark counts: tasks pre-aggregate the n-grams of
their texts, the counts are dealt by hash range, and the task of a range
writes its part of the model to the shared folder as sorted hash arrays. The
counts of a lower order (how many different words precede an n-gram) and the
context statistics (total, and how many continuations were seen once, twice,
more often) follow from the order above in the same job, dealt again by hash.
Scoring tasks memory-map the parts and look all n-grams of a batch up at once
by binary search. No part passes through the driver; it gets one row of
totals per order.

The shared folder must be one that ``pyarrow.fs`` can write (file, hdfs, s3,
gs). On a folder that is mounted everywhere the parts are mapped in place;
else each worker copies a part on first use and maps the copy, and the copies
go when the worker's task ends.

A probability at order k is ``max(count - D, 0) / total + gamma * (order k-1)``
with Chen and Goodman's three discounts per order (where the counts of counts
do not define one: 0.5, 1 and 1.5); below order 1 stands the uniform
distribution over the vocabulary and one unknown word. Contexts before a
text's begin are begin marks, counted like other words.

Defined results: a null text counts as empty and is one end token; rows with a
null id are scored, never learned from; without training rows every
probability is 1 over 1 (score 0); repeated rows count as often as they occur;
further columns are not read. A task holds its own partition's n-grams and its
own batch's tokens, so memory follows ``spark.sql.shuffle.partitions`` and the
longest text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import id_bucket, slices, text_bytes, texts
from roadlens.session import scratch_path

ORDER = 2
FLUSH = 3_000_000  # tokens that a counting task aggregates before it sends them on
SLICE_BYTES = 4 << 20

U64 = np.uint64
_END, _BEGIN = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_JOIN, _BASE = U64(0x165667B19E3779F9), U64(0x2545F4914F6CDD1D)  # odd multipliers of the hash
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += U64(32)
_LOWER += U64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first token of each text) of texts laid end to end; every text ends in an end token."""
    n = len(offsets) - 1
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    sizes = ends - starts
    hashes = np.zeros(len(starts), np.uint64)
    if len(starts):
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        hashes = np.add.reduceat(_LOWER[data[word]] * _powers(int(sizes.max()))[place], first)
    text_of = np.searchsorted(offsets[1:], starts, side="right")
    per_text = np.bincount(text_of, minlength=n) + 1
    begins = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    out = np.full(len(starts) + n, _END, np.uint64)
    out[np.arange(len(starts)) + text_of] = _mix(hashes)
    return out, begins


def contexts(word: np.ndarray, begins: np.ndarray, order: int) -> list[np.ndarray]:
    """Per k = 2..order, each token's context hash: the k-1 tokens before it, padded with begin marks."""
    out, begin, gram = [], _BEGIN, word
    for _ in range(2, order + 1):
        context = np.concatenate([[begin], gram[:-1]]).astype(np.uint64)
        context[begins] = begin
        out.append(context)
        gram = joined(context, word)
        begin = joined(np.array([begin], np.uint64), np.array([_BEGIN], np.uint64))[0]
    return out


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(context * _JOIN + word)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each key; ranges are contiguous, so the parts' order is the keys' order."""
    return ((key >> U64(33)) * U64(parts) >> U64(31)).astype(np.int64)


def _summed(key: np.ndarray, firsts: list[np.ndarray], sums: list[np.ndarray]):
    """Sorted distinct keys, with one of each key's ``firsts`` and its totals of ``sums``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return (key[at], [x[order][at] for x in firsts],
            [np.add.reduceat(x[order], at) if len(at) else x[:0] for x in sums])


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes that hold them."""
    for kind in (np.uint8, np.uint16, np.uint32):
        if not len(x) or x.max() <= np.iinfo(kind).max:
            return x.astype(kind)
    return x.astype(np.uint64)


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    """Columns as one compressed Arrow message."""
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    batch = next(pa.ipc.open_stream(data))
    return {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}


# ---- counting -------------------------------------------------------------

#: Sums that a lower order's record holds, beside its key and its words.
STATS = ["count", "raw", "total", "once", "twice", "more"]
RECORD = np.dtype([(s, np.uint64) for s in STATS])
#: An order's totals: its n-grams, those counted 1 to 4 times, the counts' sum, and that of raw counts.
TOTALS = ["grams", "n1", "n2", "n3", "n4", "total", "raw"]

#: Rows between the tasks: many n-grams of one order and hash range, packed; or, at level 0, an order's totals.
_SCHEMA = "part int, level int, data binary, " + ", ".join(f"{t} long" for t in TOTALS)


def _row(part: int, level: int, data: bytes | None, totals: list[int] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([level], pa.int32()), pa.array([data], pa.binary()),
         *[pa.array([t], pa.int64()) for t in totals or [0] * len(TOTALS)]],
        names=["part", "level", "data", *TOTALS])


def _dealt(level: int, parts: int, key: np.ndarray, columns: dict[str, np.ndarray], by: str | None):
    """A packed row per hash range; ``key`` is sorted, and a row's n-grams are put in the order of column ``by``."""
    owner = part_of(key, parts)
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
    for lo, hi in zip(edges[:-1], edges[1:]):
        # neighbours that share a context pack well
        order = np.argsort(columns[by][lo:hi], kind="stable") if by else slice(None)
        yield _row(int(owner[lo]), level, _packed({n: c[lo:hi][order] for n, c in columns.items()}))


def _chain(order: int) -> list[str]:
    """Names of the context hashes of an n-gram, from which it and its shorter ends are rebuilt."""
    return [f"c{k}" for k in range(2, order + 1)]


def _counted(batches, order: int, parts: int):
    """Pre-aggregated n-grams of the highest order."""
    held: list[list[np.ndarray]] = []

    def flush():
        columns = [np.concatenate(c) for c in zip(*held)]
        held.clear()
        key, firsts, (count,) = _summed(joined(columns[-1], columns[0]), columns, [np.ones(len(columns[0]), np.int64)])
        columns.clear()
        yield from _dealt(order, parts, key, dict(zip(["word", *_chain(order)], firsts)) | {"count": _narrow(count)},
                          f"c{order}")

    size = 0
    for batch in batches:
        for piece in slices(batch, SLICE_BYTES):
            word, begins = tokens(*text_bytes(texts(piece)))
            held.append([word, *contexts(word, begins, order)])
            size += len(word)
            if size >= FLUSH:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _written(batches, folder: str, order: int, level: int, parts: int):
    """Sum up one hash range of one order, write its arrays, and send on what the order below needs.

    Rows of level 0 pass through.
    """
    held: list[dict[str, np.ndarray]] = []
    part = 0
    for batch in batches:
        for i, kind in enumerate(batch.column("level").to_pylist()):
            if kind == level:
                part = batch.column("part")[i].as_py()
                held.append(_unpacked(batch.column("data")[i].as_py()))
            else:
                yield batch.slice(i, 1)
    if not held:
        return
    own = {n: np.concatenate([h[n] for h in held]) for n in held[0]}
    held.clear()
    if level == order:
        names = ["word", *_chain(level)]
        key, firsts, (count,) = _summed(joined(own[f"c{level}"], own["word"]), [own[n] for n in names],
                                        [own["count"].astype(np.int64)])
        _save(folder, level, part, key, count.astype(np.uint32 if count.max() < 2 ** 32 else np.uint64))
        raw = count
    else:
        names = ["word", *_chain(level)] if level > 1 else ["key"]
        # rows that know an n-gram only as a context lack its words, and go last
        first = np.argsort(own["count"] == 0, kind="stable")
        key, firsts, sums = _summed(own["key"][first], [own[n][first] for n in names],
                                    [own[s][first].astype(np.int64) for s in STATS])
        record = np.zeros(len(key), RECORD)
        for s, x in zip(STATS, sums):
            record[s] = x
        _save(folder, level, part, key, record)
        seen = sums[0] > 0
        firsts, count, raw = [x[seen] for x in firsts], sums[0][seen], sums[1][seen]
    # in the place of the part: the order whose totals these are
    yield _row(level, 0, None, [len(count), *[int((count == c).sum()) for c in (1, 2, 3, 4)], int(count.sum()),
                                int(raw.sum())])
    if level == 1:
        return
    word, chain = firsts[0], firsts[1:]
    below = word if level == 2 else joined(chain[-2], word)  # the n-gram without its first word
    ones, zeros = np.ones(len(count), np.int64), np.zeros(len(count), np.int64)
    words = [word, *chain[:-1]] if level > 2 else []
    key, firsts, sums = _summed(
        np.concatenate([below, chain[-1]]), [np.concatenate([w, np.zeros_like(w)]) for w in words],
        [np.concatenate(x) for x in ((ones, zeros), (raw, zeros), (zeros, count), (zeros, count == 1),
                                     (zeros, count == 2), (zeros, count >= 3))])
    columns = {"key": key} | dict(zip(["word", *_chain(level - 1)], firsts))
    yield from _dealt(level - 1, parts, key, columns | {s: _narrow(x) for s, x in zip(STATS, sums)}, None)


def _save(folder: str, level: int, part: int, key: np.ndarray, values: np.ndarray) -> None:
    """Write a part's two arrays; a repeated attempt replaces them by the same bytes."""
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/{level}", recursive=True)
    for kind, array in (("key", key), ("value", values)):
        draft = f"{root}/{level}/{kind}-{part:06d}.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            np.save(out, array)
        store.move(draft, f"{root}/{level}/{kind}-{part:06d}.npy")


# ---- the model ------------------------------------------------------------

@dataclass
class Level:
    """An order's totals: n-grams, their counts' sum, discounts, and what the discounts free in all."""

    grams: int
    total: int
    raw: int
    discounts: tuple[float, float, float]
    freed: float


def level_of(grams: int, n: list[int], total: int, raw: int) -> Level:
    n1, n2, n3, n4 = n
    d = [0.5, 1.0, 1.5]
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        d[0] = 1 - 2 * y * n2 / n1
        d[1] = 2 - 3 * y * n3 / n2 if n3 else d[1]
        d[2] = 3 - 4 * y * n4 / n3 if n3 and n4 else d[2]
    d = [min(max(x, 0.0), k) for k, x in enumerate(d, 1)]
    return Level(grams, total, raw, tuple(d), d[0] * n1 + d[1] * n2 + d[2] * (grams - n1 - n2))


@dataclass
class Model:
    folder: str
    order: int
    parts: int
    levels: dict[int, Level]


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Count every row of ``docs`` (``text``) and write the model to the shared folder."""
    if order < 2:
        raise ValueError("the order is at least 2")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_path(spark, "ngram-model")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    folder = folder.replace("file:///", "file:/").replace("file:/", "file:///")
    rows = docs.select("text").mapInArrow(lambda batches: _counted(batches, order, parts), _SCHEMA)
    for level in range(order, 0, -1):
        rows = rows.repartitionById(parts, "part").mapInArrow(
            lambda batches, level=level: _written(batches, folder, order, level, parts), _SCHEMA)
    # the rows left are the orders' totals, their order in the place of the part
    sums = rows.groupBy("part").agg(*[F.sum(t) for t in TOTALS]).collect()
    levels = {r[0]: level_of(int(r[1]), [int(x) for x in r[2:6]], int(r[6]), int(r[7])) for r in sums}
    for level in range(1, order + 1):
        levels.setdefault(level, Level(0, 0, 0, (0.5, 1.0, 1.5), 0.0))
    return Model(folder, order, parts, levels)


class Lookup:
    """One order's sorted arrays, memory-mapped part by part as they are needed."""

    def __init__(self, model: Model, level: int):
        self.parts, self.level, self.open = model.parts, level, {}
        self.store, self.root = pafs.FileSystem.from_uri(model.folder)

    def _map(self, path: str):
        if isinstance(self.store, pafs.LocalFileSystem):
            return np.load(path, mmap_mode="r")
        with tempfile.NamedTemporaryFile() as copy, self.store.open_input_stream(path) as source:
            while block := source.read(16 << 20):
                copy.write(block)
            copy.flush()
            return np.load(copy.name, mmap_mode="r")  # stays mapped after the name is gone

    def part(self, p: int):
        if p not in self.open:
            at = f"{self.root}/{self.level}"
            there = self.store.get_file_info(f"{at}/key-{p:06d}.npy").type != pafs.FileType.NotFound
            self.open[p] = (self._map(f"{at}/key-{p:06d}.npy"), self._map(f"{at}/value-{p:06d}.npy")) if there else None
        return self.open[p]

    def find(self, keys: np.ndarray, fields: list[str] | None = None) -> list[np.ndarray]:
        """The values of ``keys``; zero for a key that is not there."""
        distinct, back = np.unique(keys, return_inverse=True)
        out = [np.zeros(len(distinct), np.float64) for _ in fields or [""]]
        owner = part_of(distinct, self.parts)
        edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            found = self.part(int(owner[lo]))
            if found is None:
                continue
            sorted_keys, values = found
            at = np.minimum(np.searchsorted(sorted_keys, distinct[lo:hi]), len(sorted_keys) - 1)
            hit = np.flatnonzero(sorted_keys[at] == distinct[lo:hi])
            rows = values[at[hit]]
            for x, field in zip(out, fields or [""]):
                x[lo + hit] = rows[field] if field else rows
        return [x[back] for x in out]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.lookups = {k: Lookup(model, k) for k in range(1, model.order + 1)}

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base log10 score, model log10 score."""
        model = self.model
        word, begins = tokens(data, offsets)
        chain = contexts(word, begins, model.order)
        first = model.levels[1]
        count, raw = self.lookups[1].find(word, ["count", "raw"])
        vocabulary = first.grams
        p = np.full(len(word), 1.0 / (vocabulary + 1))
        if first.total:
            p = (_kept(count, first) + first.freed * p) / first.total
        for k in range(2, model.order + 1):
            total, once, twice, more = self.lookups[k - 1].find(chain[k - 2], STATS[2:])
            key = joined(chain[k - 2], word)
            seen = self.lookups[k].find(key, ["count"] if k < model.order else None)[0]
            d = model.levels[k].discounts
            inner = (_kept(seen, model.levels[k]) + (d[0] * once + d[1] * twice + d[2] * more) * p)
            p = np.where(total > 0, inner / np.maximum(total, 1), p)
        base = np.log10((raw + 1) / (first.raw + vocabulary + 1))
        size = np.diff(np.concatenate([begins, [len(word)]]))
        add = np.add.reduceat
        return size, add((raw > 0).astype(np.int64), begins), add(base, begins), add(np.log10(p), begins)


def _kept(count: np.ndarray, level: Level) -> np.ndarray:
    """Counts less their discounts."""
    d = np.array([0.0, *level.discounts])
    return np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0.0)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` per document."""
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                size, known, base, score = scorer.score(*text_bytes(texts(piece)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
            .withColumn("train_tokens", F.lit(model.levels[1].raw).cast("long"))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on the documents that are not held out (crc32 of the id mod 7 is not 2), score all."""
    held_out = F.coalesce(id_bucket("doc_id", 7) == 2, F.lit(False))
    learn = F.coalesce(id_bucket("doc_id", 7) != 2, F.lit(False))
    model = train(docs.filter(learn), order)
    return scores(docs, model).withColumn("held_out", held_out)
