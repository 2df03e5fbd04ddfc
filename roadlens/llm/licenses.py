"""Operator 4: licence scans, in DataFrame functions only.

Every line of a file is compared with the notice templates by the cosine of
sparse TF-IDF vectors (terms: runs of ``[a-z0-9]`` in lower case; idf over the
templates, ``ln((1 + T) / (1 + df)) + 1``; a term of no template has df 0, a
function word df T). A file's own licence is the best template of its lines that reach
``THRESHOLD``. A line that reaches it has one of the template's anchor
terms (its other terms together are too short, by Cauchy and Schwarz), so a
scan for those terms sets aside the lines that cannot match, and nothing else.

A notice may be wrapped over lines or stand inside a longer one, and a licence
may be given by its title, header or whole text. So the sentences of a text
(line ends within a paragraph are no end of one) are compared with the notices
too, and its sentences and runs of paragraphs with ``TEXTS``, as vectors with
an idf of their own. A paragraph ends where a line has no letter or digit. A
run has any number of paragraphs, the first and the last with an anchor term of
``TEXTS``, and at most twice the longest template's characters; of the runs
from one paragraph that have more than ``SHORT`` of them, each has a quarter
more characters than the one before. Texts are cut for this into overlapping
stretches of ``STRETCH`` characters, and a run is put together only when its
length is known, so no row holds more than a stretch. The most similar of all
matches counts.

A licence file is one named like LICENSE or COPYING, or one whose matching
lines (or without any its longest other match, or its longest match with one
of ``TEXTS``) hold at least ``FILE_SHARE`` of its characters. It gives its licence (of
several in one directory the most similar, then the smallest path) to its
directory; a file without a licence of its own takes that of the nearest
directory above it. This is settled once per directory, by equal-key joins on
the directories' ancestors, and files join their directory.

Defined results: a null or empty text has no licence of its own and may
inherit one; a file with a null path is in no tree and is not scanned (licence
null, origin ``none``); different texts under one path are scanned apart, and
the best match of any is that of the path; ties go to the licence named first in the alphabet; an empty table gives an empty result;
further columns pass through, but for those named like the results, which are
replaced. Only the templates are broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadlens.llm.licence_texts import TEXTS
from roadlens.session import materialize

THRESHOLD = 0.75
FILE_SHARE = 0.3
TERM = "[a-z0-9]+"
SHORT, STRETCH = 8, 32_768
PARAGRAPH_END = r"\n(?:[^A-Za-z0-9\n]*(?:\n|$))+"
SENTENCE_END = r"(?<=[.!?:])(?:[^A-Za-z0-9\n]{0,8}\n|\s+(?=[^A-Za-z0-9]{0,4}[A-Z]))"  # bounded, so linear in any script
FILE_NAME = r"(?i)^(un)?licen[sc]e|^copying|^notice"

# English function words, which say nothing about a licence.
FUNCTION_WORDS = ("a all an and are as at be by can for form found from had has have in into is it its of on or that "
                  "the their these this those to under use was were which with").split()

# The notices by which public licences are applied to a work.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


class Notices:
    """Weights of the templates' terms: ``idf`` (and ``unknown``) and unit vectors."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        counts = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
        df = Counter(t for c in counts for t in c)
        n = len(templates)
        df.update({t: n - df[t] for t in FUNCTION_WORDS})
        self.idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items()}
        self.unknown = math.log(1 + n) + 1
        self.most_chars = 2 * max(len(text) for _, text in templates)
        self.terms, self.anchors = [], set()  # (licence, template, term, weight)
        for number, ((licence, _), count) in enumerate(zip(templates, counts)):
            weights = {t: c * self.idf[t] for t, c in count.items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            self.terms += [(licence, number, t, w / norm) for t, w in weights.items()]
            rest = norm * norm
            # any order will do: long words first, which are rare in other texts
            for t, w in sorted(weights.items(), key=lambda x: (x[0] in FUNCTION_WORDS, len(x[0]) < 3, -x[1], x[0])):
                if rest < (threshold * norm) ** 2 * (1 - 1e-9):
                    break
                self.anchors.add(t)
                rest -= w * w

    def anchor_pattern(self, *others: Notices) -> str:
        anchors = self.anchors.union(*[o.anchors for o in others])
        return "(?<![a-z0-9])(?:" + "|".join(sorted(anchors)) + ")(?![a-z0-9])"

    def may_match(self, terms: str, threshold: float) -> Column:
        """False only for lines that cannot reach the threshold.

        With M terms of the templates (repeats counted) and U different other
        terms, a line's squared cosine with any template is at most
        K / (K + U * unknown ** 2) for a K of at most (M * highest idf) ** 2.
        """
        known = F.array(*[F.lit(t) for t in sorted(self.idf)])
        m = F.size(F.filter(terms, lambda t: F.array_contains(known, t)))
        u = F.size(F.array_except(F.col(terms), known))
        most = max(self.idf.values()) * (1 + 1e-9)
        return (m * F.lit(most)) ** 2 * (1 - threshold ** 2) >= u * F.lit((self.unknown * threshold) ** 2)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(term, idf) and (licence, template, term, weight)."""
        return (spark.createDataFrame(sorted(self.idf.items()), "term string, idf double"),
                spark.createDataFrame(self.terms, "licence string, template int, term string, weight double"))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _matches(units: DataFrame, notices: Notices, threshold: float, name: str) -> DataFrame:
    """``path, text_key, best, chars, size`` of the ``units`` (``path, text_key, size, line, words``) that reach the threshold."""
    idf, terms = notices.tables(units.sparkSession)
    key = ["path", "text_key", "line"]
    lines = (units.filter(F.lower("words").rlike(notices.anchor_pattern()))
             .select(*key, "size", F.char_length("words").alias("chars"), _terms(F.col("words")).alias("terms"))
             .filter(notices.may_match("terms", threshold)))
    # few, and read more than once; a text that stands there twice counts once
    lines = materialize(lines.distinct(), name)
    counted = (lines.select(*key, "chars", "size", F.explode("terms").alias("term"))
               .groupBy(*key, "term")
               .agg(F.count(F.lit(1)).alias("n"), F.max("chars").alias("chars"), F.max("size").alias("size")))
    weighed = (counted.join(F.broadcast(idf), "term", "left")
               .withColumn("weight", F.col("n") * F.coalesce("idf", F.lit(notices.unknown))))
    norms = weighed.groupBy(*key).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"), F.max("chars").alias("chars"),
        F.max("size").alias("size"))
    dots = (weighed.select(*key, "term", F.col("weight").alias("w"))
            .join(F.broadcast(terms), "term").groupBy(*key, "template", "licence")
            .agg(F.sum(F.col("w") * F.col("weight")).alias("dot")))
    matched = (dots.join(norms, key)
               .withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6))
               .filter(F.col("similarity") >= threshold))
    best = F.struct((-F.col("similarity")).alias("s"), F.col("licence").alias("l"))
    return matched.groupBy(*key).agg(F.min(best).alias("best"), F.max("chars").alias("chars"),
                                     F.max("size").alias("size")).drop("line")


def _texts(files: DataFrame, *notices: Notices) -> DataFrame:
    """``path, text_key, size, text`` of the files that have an anchor."""
    return (files.filter(F.col("path").isNotNull() & F.lower("text").rlike(notices[0].anchor_pattern(*notices[1:])))
            .select("path", F.xxhash64("text").alias("text_key"), F.char_length("text").alias("size"), "text"))


def _units(files: DataFrame, split: Column, *notices: Notices) -> DataFrame:
    """``path, text_key, size, line, words`` of the parts of the texts that have an anchor."""
    return (_texts(files, *notices).select("path", "text_key", "size", F.posexplode(split).alias("line", "words"))
            .filter(F.lower("words").rlike(notices[0].anchor_pattern(*notices[1:]))))


def sentences(text: str) -> Column:
    return F.flatten(F.transform(F.split(text, PARAGRAPH_END), lambda p: F.split(p, SENTENCE_END)))


def _stretches(texts: DataFrame, length: int, overlap: int) -> DataFrame:
    """``texts`` in pieces of ``length`` characters and ``overlap`` more: ``text``, and whether it begins and ends there."""
    n = F.col("length")
    pieces = texts.withColumn("length", F.char_length("text")).select(
        "*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(length))).alias("from"))
    return pieces.select(
        *[c for c in texts.columns if c not in ("text", "begins", "ends")],
        F.when((F.col("from") == 0) & (n <= length), F.col("text"))
        .otherwise(F.substring("text", F.col("from") + 1, F.lit(length + overlap))).alias("text"),
        (F.col("begins") & (F.col("from") == 0)).alias("begins"),
        (F.col("ends") & (F.col("from") + length + overlap >= n)).alias("ends"))


def paragraph_runs(texts: DataFrame, anchors: str, most: int, stretch: int = STRETCH) -> DataFrame:
    """``path, text_key, size, words`` of the runs of paragraphs with anchors at both ends and ``most`` characters at most."""
    whole = texts.withColumns({"begins": F.lit(True), "ends": F.lit(True)})
    # twice, as a place far inside a long text is slow to find
    near = _stretches(_stretches(whole, 64 * stretch, 2 * most), stretch, 2 * most)
    parts = (near.filter(F.lower("text").rlike(anchors)).withColumn("parts", F.split("text", PARAGRAPH_END))
             # a paragraph that a stretch cuts is whole in another stretch, or too long
             .withColumn("low", F.when(F.col("begins"), 0).otherwise(1))
             .withColumn("high", F.size("parts") - F.when(F.col("ends"), 0).otherwise(1)))
    starts = (parts.filter(F.col("low") < F.col("high"))
              .select("path", "text_key", "size", "parts", "high",
                      F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("at"))
              .filter(F.lower(F.get("parts", F.col("at"))).rlike(anchors)
                      & (F.char_length(F.get("parts", F.col("at"))) <= most))
              # no more paragraphs than that many characters hold
              .select("path", "text_key", "size", F.slice("parts", F.col("at") + 1, F.least(
                  F.col("high") - F.col("at"), F.lit(most // 2 + 1))).alias("parts")))
    start = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("n"), F.lit(0).alias("kept"),
                     F.array().cast("array<int>").alias("lasts"))

    def longer(state: Column, part: Column) -> Column:
        chars, n = state["chars"] + F.char_length(part) + 1, state["n"] + 1
        taken = ((chars - 1 <= most) & ((n <= SHORT) | (4 * chars >= 5 * state["kept"])) & F.lower(part).rlike(anchors))
        return F.struct(chars.alias("chars"), n.alias("n"), F.when(taken, chars).otherwise(state["kept"]).alias("kept"),
                        F.when(taken, F.concat(state["lasts"], F.array(n))).otherwise(state["lasts"]).alias("lasts"))

    lasts = F.aggregate("parts", start, longer, lambda state: state["lasts"])
    return (starts.select("path", "text_key", "size", "parts", F.explode(lasts).alias("n"))
            .select("path", "text_key", "size", F.array_join(F.slice("parts", F.lit(1), F.col("n")), "\n").alias("words")))


def own_licences(files: DataFrame, notices: Notices, threshold: float = THRESHOLD,
                 texts: Notices | None = None) -> DataFrame:
    """``path, licence, similarity, share`` (of the file's characters that match) of files with a notice."""
    both = [notices, texts] if texts else [notices]
    inside = materialize(_units(files, sentences("text"), *both), "sentences")  # few, and read for each
    found = [_matches(_units(files, F.split("text", "\n"), notices), notices, threshold, "licence-lines")
             .withColumn("kind", F.lit(0)),
             _matches(inside, notices, threshold, "licence-sentences").withColumn("kind", F.lit(1))]
    if texts:
        runs = paragraph_runs(_texts(files, texts), texts.anchor_pattern(), texts.most_chars)
        units = inside.drop("line").unionByName(runs).withColumn("line", F.xxhash64("words"))  # equal words are one unit
        found.append(_matches(units, texts, threshold, "licence-texts").withColumn("kind", F.lit(2)))
    matched = found[0]
    for more in found[1:]:
        matched = matched.unionByName(more)

    def chars(kind: int, total=F.max) -> Column:
        return total(F.when(F.col("kind") == kind, F.col("chars")))

    by_text = matched.groupBy("path", "text_key").agg(
        F.min("best").alias("best"), (F.greatest(F.coalesce(chars(0, F.sum), chars(1)), chars(2)) / F.max("size")).alias("share"))
    return (by_text.groupBy("path").agg(F.min("best").alias("best"), F.max("share").alias("share"))
            .select("path", F.col("best.l").alias("licence"), (-F.col("best.s")).alias("similarity"), "share"))


def directory(path: Column) -> Column:
    """The directory of a path; empty for a path without one."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """(folder, how far up) of a directory and all above it, the root (empty) last."""
    parts = F.when(folder == "", F.array().cast("array<string>")).otherwise(F.split(folder, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda up: F.struct(
        F.array_join(F.slice(parts, 1, F.size(parts) - up), "/").alias("above"), up.alias("up")))


def licence_scan(files: DataFrame, templates: list[tuple[str, str]] | None = None,
                 threshold: float = THRESHOLD, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``files`` (``path``, ``text``, ...) with ``licence, similarity, origin, licence_from``.

    ``origin`` is ``own``, ``inherited`` or ``none``; ``licence_from`` is the
    file whose notice counts. ``texts`` are ``TEXTS``, unless other templates are given.
    """
    texts = texts if texts is not None else [] if templates else TEXTS
    own = materialize(own_licences(files, Notices(templates or TEMPLATES, threshold), threshold,
                                   Notices(texts, threshold) if texts else None), "own-licences")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    giving = own.filter(name.rlike(FILE_NAME) | (F.col("share") >= FILE_SHARE))
    best = F.struct((-F.col("similarity")).alias("s"), F.col("path").alias("p"), F.col("licence").alias("l"))
    of_folder = giving.groupBy(directory(F.col("path")).alias("above")).agg(F.min(best).alias("best"))
    columns = [c for c in files.columns if c not in ("text", "licence", "similarity", "origin", "licence_from")]
    inner = {c: f"__in_{i}" for i, c in enumerate(columns)}  # so that no column clashes with those below
    rows = files.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], directory(F.col("path")).alias("__folder"))
    folders = rows.select("__folder").filter(F.col("__folder").isNotNull()).distinct()
    nearest = (folders.select("__folder", F.inline(ancestors(F.col("__folder"))))
               .join(of_folder, "above").groupBy("__folder").agg(F.min_by("best", "up").alias("__above")))
    mine = own.select(F.col("path").alias(inner["path"]), F.struct("licence", "similarity").alias("__own"))
    joined = rows.join(mine, inner["path"], "left").join(nearest, "__folder", "left")
    path, has, above = F.col(inner["path"]), F.col("__own").isNotNull(), F.col("__above")
    return joined.select(
        *[F.col(n).alias(c) for c, n in inner.items()],
        F.when(has, F.col("__own.licence")).otherwise(above["l"]).alias("licence"),
        F.when(has, F.col("__own.similarity")).otherwise(-above["s"]).alias("similarity"),
        F.when(has, "own").when(above.isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(has, path).otherwise(above["p"]).alias("licence_from"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: ``doc_id, path`` (source / hundreds / id) and ``text``."""
    number = F.col("doc_id").cast("string")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.expr("doc_id div 1000").cast("string"),
                         F.expr("doc_id div 100").cast("string"))
    return docs.select("doc_id", F.concat(folder, F.lit("/"), number, F.lit(".txt")).alias("path"), "text")


def document_licence_sql() -> str:
    """DuckDB SQL for the scan of :func:`document_files`."""
    notices = Notices(TEMPLATES, THRESHOLD)
    idf = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in sorted(notices.idf.items()))
    terms = ", ".join(f"('{name}', {n}, '{t}', {w!r}::DOUBLE)" for name, n, t, w in notices.terms)
    return rf"""
        WITH idf(term, idf) AS (VALUES {idf}), weights(licence, template, term, weight) AS (VALUES {terms}),
        f AS (SELECT doc_id, coalesce(source, 'unknown') || '/' || (doc_id // 1000) || '/' || (doc_id // 100) AS folder,
                     folder || '/' || doc_id || '.txt' AS path, text FROM documents),
        l AS (SELECT path, length(text) AS size, unnest(string_split(text, chr(10))) AS words,
                     generate_subscripts(string_split(text, chr(10)), 1) AS line FROM f),
        t AS (SELECT path, line, unnest(regexp_extract_all(lower(words), '{TERM}')) AS term FROM l),
        c AS (SELECT path, line, term, count(*) AS n FROM t GROUP BY ALL),
        w AS (SELECT path, line, term, n * coalesce(idf, {notices.unknown!r}::DOUBLE) AS w FROM c LEFT JOIN idf USING (term)),
        norms AS (SELECT path, line, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
        dots AS (SELECT path, line, template, licence, sum(w * weight) AS dot FROM w JOIN weights USING (term) GROUP BY ALL),
        m AS (SELECT path, line, licence, round(dot / norm, 6) AS s FROM dots JOIN norms USING (path, line)
              WHERE round(dot / norm, 6) >= {THRESHOLD}),
        shares AS (SELECT path, sum(length(words)) / any_value(size) AS share
                   FROM l JOIN (SELECT DISTINCT path, line FROM m) USING (path, line) GROUP BY path),
        own AS (SELECT path, first(licence ORDER BY s DESC, licence) AS licence, max(s) AS similarity FROM m GROUP BY path),
        giving AS (SELECT folder AS above, first(o.licence ORDER BY similarity DESC, path) AS licence,
                          first(similarity ORDER BY similarity DESC, path) AS similarity,
                          first(path ORDER BY similarity DESC, path) AS path
                   FROM own o JOIN shares USING (path) JOIN f USING (path) WHERE share >= {FILE_SHARE} GROUP BY folder),
        up AS (SELECT folder, unnest(range(0, 4)) AS up FROM (SELECT DISTINCT folder FROM f)),
        above AS (SELECT folder, up, array_to_string(string_split(folder, '/')[1:3 - up], '/') AS above FROM up),
        near AS (SELECT folder, arg_min(g, up) AS g FROM above JOIN giving g USING (above) GROUP BY folder)
        SELECT f.doc_id, f.path, coalesce(o.licence, near.g.licence) AS licence,
               coalesce(o.similarity, near.g.similarity) AS similarity,
               CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN near.g IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
               CASE WHEN o.licence IS NOT NULL THEN f.path ELSE near.g.path END AS licence_from
        FROM f LEFT JOIN own o USING (path) LEFT JOIN near USING (folder)"""
