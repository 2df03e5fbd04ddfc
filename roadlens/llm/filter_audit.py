"""Operator 12: what each filter removes under every order of the filters.

A document is known by the set of filters it fails (its mask); only how many
documents of a part share a mask matters. With the orders of k filters in
lexicographic order, all orders that begin alike are neighbours: a beginning
of s filters covers an interval of (k - s)! ranks, the first of them by its
Lehmer code. A mask is removed at step s by filter f under exactly those
orders that begin with s - 1 filters outside the mask and then f. So each
(mask, beginning) adds its documents at the first rank of the interval and
takes them off after the last, and a running sum over the k! ranks gives the
documents removed at each step of each order. No document is filtered more
than once, whatever the number of orders.

The filter for repeated texts looks at the whole table: a document fails it if
an equal text (by SHA-256) has a smaller id. Groups of copies are counted
before they are shuffled, and only the counts meet by digest.

Defined results: a null text is empty; rows with a null id fail no
``repeated`` filter and make nobody else fail it; rows that repeat an id count
each, and none of them is smaller than another; a document is labelled by the
largest ``quality`` and ``toxic`` of its id's rows, unlabelled ones are never
lost as good or toxic; a null language is the part ``''``; an empty table
gives an empty result; further columns of ``documents`` are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadlens.llm.common import WHITESPACE

SALTS = 64  # of rows without an id


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """The text filters' failure conditions (of a text without nulls and its words)."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(words) < 100,
            "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
            "C": 100 * capitals > 10 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def white_words(text: Column) -> Column:
    """Maximal runs of other characters than white space."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def mask_counts(documents: DataFrame, labels: DataFrame, failures=text_failures) -> tuple[DataFrame, str]:
    """``part, mask, n, good, toxic`` and the filters' names; bit i of the mask is the i-th name, the last is ``E``."""
    texts = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"),
                             F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("words", white_words(F.col("text")))
    conditions = failures(F.col("text"), F.col("words"))
    names = "".join(conditions) + "E"
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())]
    cell = ["digest", "part", "mask"]
    rows = (texts.select("doc_id", "part", F.sha2("text", 256).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
            .groupBy("doc_id", *cell).agg(F.count(F.lit(1)).alias("n")))  # rows that repeat an id and a text meet here
    # labels; rows without an id have none, and are spread by their text
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0).cast("int")
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).withColumn("salt", F.lit(0)))
    rows = (rows.withColumn("salt", salt).join(marks, ["doc_id", "salt"], "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")}))
    # of each kind of copies: the smallest id, its rows, and the rows without an id
    known = F.col("doc_id").isNotNull()
    kinds = (rows.groupBy(*cell, "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("nameless")))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    fresh = (F.col("nameless") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    repeated = 1 << (len(names) - 1)
    split = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
                              F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - F.col("fresh")).alias("n"))))
    return (kinds.withColumn("fresh", fresh).select("part", "good", "toxic", split.alias("of"))
            .groupBy("part", F.col("of.mask").alias("mask"))
            .agg(F.sum("of.n").alias("n"), F.sum(F.col("of.n") * F.col("good")).alias("good"),
                 F.sum(F.col("of.n") * F.col("toxic")).alias("toxic"))
            .filter(F.col("n") > 0), names)


def intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of every beginning that removes the mask at its last filter."""
    out = []
    for step in range(1, k + 1):
        for start in itertools.permutations(range(k), step):
            left, low = list(range(k)), 0
            for at, f in enumerate(start):  # Lehmer code
                low += left.index(f) * math.factorial(k - 1 - at)
                left.remove(f)
            for n in range(len(left) + 1):
                for others in itertools.combinations(left, n):
                    mask = (1 << start[-1]) + sum(1 << f for f in others)
                    out.append((mask, step, low, low + math.factorial(k - step)))
    return out


def orders(names: str) -> list[str]:
    """All orders of the filters in lexicographic order of their places in ``names``."""
    return ["".join(p) for p in itertools.permutations(names)]


def interaction(spark: SparkSession, counts: DataFrame, names: str) -> DataFrame:
    """Every part, order and step from the mask counts; the constant tables grow with the filters only."""
    k, ranks = len(names), math.factorial(len(names))
    values = ["n", "good", "toxic"]
    table = spark.createDataFrame(intervals(k), "mask int, step int, low int, high int")
    ends = F.explode(F.array(F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign"))))
    marks = (counts.join(F.broadcast(table), "mask").select("part", "step", *values, ends.alias("end"))
             .groupBy("part", "step", F.col("end.rank").alias("rank"))
             .agg(*[F.sum(F.col(v) * F.col("end.sign")).alias(v) for v in values]))
    letters = [F.lit(c) for c in names]
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(k)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(k)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("whole"), F.array(*fails).alias("fails"),
                                       F.array(*alone).alias("alone"))
    grid = (parts.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
            .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1)))))
    so_far = Window.partitionBy("part", "step").orderBy("rank")
    earlier = Window.partitionBy("part", "rank").orderBy("step")
    of_filter = Window.partitionBy("part", "filter")
    at = F.col("place") - 1
    return (grid.join(marks, ["part", "step", "rank"], "left")
            .withColumns({v: F.sum(F.coalesce(v, F.lit(0))).over(so_far) for v in values})
            .withColumn("filter_order", F.element_at(F.array(*[F.lit(o) for o in orders(names)]), F.col("rank") + 1))
            .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
            .withColumn("place", F.array_position(F.array(*letters), F.col("filter")).cast("int"))
            .select("part", "filter_order", "step", "filter", (F.col("whole") - F.sum("n").over(earlier)).alias("kept"),
                    F.col("n").alias("removed"), (F.get("fails", at) - F.col("n")).alias("redundant"),
                    F.get("alone", at).alias("unique_fails"), F.col("good").alias("good_lost"),
                    F.col("toxic").alias("toxic_lost"), F.sum("n").over(of_filter).alias("shapley")))


def filter_audit(documents: DataFrame, labels: DataFrame, failures=text_failures) -> DataFrame:
    """``part, filter_order, step, filter`` with ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    counts, names = mask_counts(documents, labels, failures)
    return interaction(documents.sparkSession, counts, names)


FILTER_AUDIT_SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                 min(doc_id) OVER (PARTITION BY text) AS least FROM d),
    f AS (
        SELECT part,
               CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails,
               coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
        FROM w LEFT JOIN (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
                          FROM labels GROUP BY doc_id) l ON l.id = w.doc_id),
    c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
          FROM letters a, letters b, letters c, letters d, letters e
          WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
            AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
    s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter
          FROM o, generate_series(1, 5) AS g(step)),
    r AS (
        SELECT c.part, s.filter_order, s.step, s.filter,
               sum(n) AS whole,
               sum(CASE WHEN contains(fails, filter) AND regexp_replace(fails, '[' || filter_order[:step - 1] || '.]', '', 'g') = fails
                        THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN contains(fails, filter) THEN n ELSE 0 END) AS failing,
               sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN contains(fails, filter) AND regexp_replace(fails, '[' || filter_order[:step - 1] || '.]', '', 'g') = fails
                        THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN contains(fails, filter) AND regexp_replace(fails, '[' || filter_order[:step - 1] || '.]', '', 'g') = fails
                        THEN toxic ELSE 0 END) AS toxic_lost
        FROM c, s GROUP BY c.part, s.filter_order, s.step, s.filter)
    SELECT part, filter_order, step, filter,
           CAST(whole - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
           CAST(removed AS BIGINT) AS removed, CAST(failing - removed AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
    FROM r"""
