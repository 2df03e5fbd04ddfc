"""Operator 3: exact dedup with a heavy-hitter split, in DataFrame functions only.

Texts are equal when they are the same after deleting ASCII white space; of
equal texts the row with the most code points stays, then the smallest
``doc_id``. Per row only the digest, the length and the id go on.

1. Frequent digests: the frequent-items sketch behind ``approx_top_k`` (a
   Misra-Gries summary that Spark merges) runs per digest bucket, so neither
   its maps nor their merge meet in one task. It names at most
   ``BUCKETS * TOP`` digests.
2. Their exact counts and winners come from an aggregation over all rows (a
   hot digest collapses before its shuffle). This table, at most
   ``BUCKETS * TOP`` rows, is broadcast and settles the frequent digests'
   rows where they are read, without a shuffle.
3. The rows of all other digests are shuffled by digest and settled by one
   window each; no such group is frequent.

The sketch only decides which way a group takes: both ways give the same
rows, so an estimate that misses or adds a digest changes nothing.

Defined results: a null text counts as empty; a null ``doc_id`` comes after
every id; of repeated rows (same id, same text) one is marked ``kept``; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.llm.common import WHITESPACE, keep_rows, text_key
from roadlens.session import materialize

BUCKETS = 32
TOP = 32
TRACKED = 256


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITESPACE, "")


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: ``doc_id, text_key, chars, text_sha256, row_no``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialize(
        docs.select("doc_id", text_key().alias("text_key"), F.char_length(text).alias("chars"),
                    F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"),
                    F.monotonically_increasing_id().alias("row_no")), "text-digests")


def frequent_digests(rows: DataFrame) -> DataFrame:
    """At most ``BUCKETS * TOP`` digests, every one that is frequent among them."""
    bucket = F.pmod(F.xxhash64("text_sha256"), F.lit(BUCKETS)).alias("bucket")
    return (rows.groupBy(bucket).agg(F.expr(f"approx_top_k(text_sha256, {TOP}, {TRACKED})").alias("top"))
            .select(F.explode("top").alias("top")).filter("top.count > 1")
            .select(F.col("top.item").alias("text_sha256")))


def _first() -> list[Column]:
    """The order of preference within a group, as sort keys."""
    return [F.col("chars").desc(), F.col("doc_id").asc_nulls_last(), F.col("row_no").asc()]


def _rank() -> Column:
    """The same order as one comparable value, smallest first."""
    return F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"),
                    F.col("doc_id").alias("d"), F.col("row_no").alias("r"))


def _verdict(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "keep_id", "group_size",
                       (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256", "text_key")


def decide(rows: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, text_key`` for every row of :func:`digests`."""
    names = materialize(frequent_digests(rows), "frequent-digests")
    winners = materialize(
        rows.join(F.broadcast(names), "text_sha256", "left_semi")
        .groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.min(_rank()).alias("best"))
        .select("text_sha256", "group_size", F.col("best.d").alias("keep_id"), F.col("best.r").alias("keep_row")),
        "frequent-winners")
    hot = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    best = group.orderBy(*_first()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = (rows.join(F.broadcast(winners), "text_sha256", "left_anti")
            .withColumn("group_size", F.count(F.lit(1)).over(group))
            .withColumn("keep_id", F.first("doc_id").over(best))
            .withColumn("keep_row", F.first("row_no").over(best)))
    return _verdict(hot).unionByName(_verdict(rest))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return decide(digests(docs)).drop("text_key")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    # an id and text that repeat are one key: kept if one of its rows is
    verdict = (decide(digests(docs)).groupBy("doc_id", "text_key")
               .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies")))
    return keep_rows(docs, materialize(verdict, "exact-dedup-verdict"))
