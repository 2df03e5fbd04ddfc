"""Operator 8: SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint bit is set when more than half of a text's shingle hashes have
it. Documents with one fingerprint are one class from then on. Two
fingerprints within ``distance`` bits share a value within half of that from
each of them, so every distinct fingerprint emits all values within
``ceil(distance / 2)`` bits of itself, the values are shuffled, and
fingerprints that meet at a value are candidates. A value's members are
distinct fingerprints from a ball of that radius, so its group is bounded
(65 for a distance of 2) however many documents there are, and linking each
member to the smallest member that it lies near links them all; every link is
verified by counting the differing bits. Links are deduplicated, and their
components found with written tables between rounds.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a null ``doc_id`` has its
fingerprint and component but is never a ``component_id`` (a component of
such rows alone has a null one); repeated rows are one class; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadlens.llm.common import keep_rows, slices, text_key, texts
from roadlens.llm.components import components
from roadlens.session import materialize

SHINGLE, DISTANCE, SEED = 3, 2, 42
SLICE_BYTES = 2 << 20
BATCH = 1 << 16  # shingle hashes whose bits are unpacked at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, unsigned."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    ends, starts = ends[width - 1:].tolist(), starts[:len(words) - width + 1].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), BATCH):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED)
                           for a, b in zip(starts[at:at + BATCH], ends[at:at + BATCH])], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(ends)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` (a signed long) per document, written once."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = np.array([fingerprint(t.as_py().encode(), shingle) for t in texts(part)], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(found.view(np.int64))],
                    names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return materialize(rows.mapInArrow(run, "doc_id long, text_key long, fp long"), "fingerprints")


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Distinct verified links (``a, b``) that connect what lies within ``distance`` bits.

    Up to a distance of 2 all members of a value's group lie within
    ``distance`` of each other, so each is linked to the smallest; beyond,
    candidates of a group (bounded by the ball, not by the data) are paired
    and those too far apart dropped.
    """
    radius = (distance + 1) // 2
    # made in the plan, so that the ball's size is no limit on the size of an expression
    masks = F.array(*[F.lit(m) for m in ball_masks(radius)])
    balls = classes.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    if 2 * radius <= distance:
        met = balls.withColumn("b", F.min("fp").over(Window.partitionBy("value")))
        pairs = met.filter("fp > b").select(F.col("fp").alias("a"), "b")
    else:
        met = balls.groupBy("value").agg(F.collect_set("fp").alias("all")).filter("size(all) > 1")
        pairs = (met.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
                 .filter("a > b"))
    return pairs.distinct().filter(near)


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, text_key, fp, component_id`` and the component's ``root`` per document."""
    rows = fingerprints(docs, shingle)
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = components(links(classes, distance)).select(F.col("node").alias("fp"), "root")
    members = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = members.groupBy("root").agg(F.min("first").alias("component_id"))
    named = members.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits)``, component_id`` per document."""
    return (grouped(docs, shingle, distance)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component (its smallest id), with all columns."""
    keys = (grouped(docs, shingle, distance).groupBy("doc_id", "text_key", "root")
            .agg(F.count(F.lit(1)).alias("copies")))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    best = keys.groupBy("root").agg(F.min(order).alias("best"))
    verdict = keys.join(best, "root").select(
        "doc_id", "text_key", "copies",
        (F.col("best.d").eqNullSafe(F.col("doc_id")) & (F.col("best.t") == F.col("text_key"))).alias("kept"))
    return keep_rows(docs, materialize(verdict, "near-dedup-verdict"))
