"""Operator 11: benchmark passages in documents by a prefix-filtered set join, in DataFrame functions only.

An item's window is a run of ``words`` item words (the whole item, if it has
fewer), seen as the set of its word shingles with their places. A document
contains a window where a run of document words of the window's size has at
least ``least`` of these shingles at the same places; at 1.0, the contract's
value, that is the window itself.

* Order: the documents' occurrences of the windows' shingles are counted, over
  all documents, and each window's shingles put in order of rarity.
* Prefix: of s shingles of which c = ceil(least * s) have to be there, one of
  the s - c + 1 rarest is. Only these are joined with the documents' words; a
  window one of whose necessary shingles is all it has left occurs nowhere if
  that shingle does not.
* Bounds: a shingle at place p of a document and o of a window stands for the
  run that starts at p - o, which has to lie within the document.
* Verification: the words of that run are compared with the window's, in the
  same task that read the document. Hashes only name candidates.

The shingle tables are broadcast in blocks of ``BLOCK`` rows at most; a larger
benchmark gives more blocks, each held against all documents. Documents are
read once for the counts and once for each block, and only hits are shuffled.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased. Defined results: a null or empty text has no words and no
hits; a null item id marks words but is not counted or listed; rows repeating
an item count once; rows repeating a document's id and text give a row each;
equal windows of many items are searched once; an empty benchmark leaves every
document clean, an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadlens.session import materialize

WORDS, SHINGLE, LEAST = 10, 3, 1.0
BLOCK = 200_000  # rows of a broadcast table

#: What is no part of a word: ASCII but for letters and digits.
SEPARATORS = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    lower = F.translate(trimmed, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(lower, _GAP))


def _shingle(words: Column, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from place ``at`` (0, 1, ...)."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def item_windows(items: DataFrame, words: int = WORDS, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, words`` of every distinct window, with ``size`` and ``width`` of its shingles."""
    whole = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - words, F.lit(0)))
    return (whole.filter(F.size("all") > 0).select("item_id", "all", F.explode(starts).alias("start"))
            .select("item_id", F.slice("all", F.col("start") + 1, words).alias("words")).distinct()
            .withColumn("size", F.size("words")).withColumn("width", F.least(F.col("size"), F.lit(shingle))))


def _shingles(windows: DataFrame, widths: list[int]) -> Column:
    """``place, hash`` of a window's shingles."""
    at = F.sequence(F.lit(0), F.col("size") - F.col("width"))

    def of(width: int) -> Column:
        return F.transform(at, lambda i: F.struct(i.alias("place"), _shingle(F.col("words"), i, width).alias("hash")))

    return F.inline(F.coalesce(*[F.when(F.col("width") == w, of(w)) for w in widths]))


def _positions(documents: DataFrame, widths: list[int], markers: bool) -> DataFrame:
    """A row per word and shingle width: ``doc_id, text_key, words, at, hash``; a marker at -1 for the document."""
    docs = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
                            words_of(F.col("text")).alias("words"))
    # outer, so that no filter on the generator's input evaluates it once more
    first = F.lit(-1 if markers else 0)
    docs = docs.select("*", F.explode_outer(F.sequence(first, F.greatest(F.size("words") - 1, first))).alias("at"))
    if len(widths) == 1:
        return docs.withColumn("hash", F.when(F.col("at") >= 0, _shingle(F.col("words"), F.col("at"), widths[0])))
    each = F.array(*[_shingle(F.col("words"), F.col("at"), w) for w in widths])
    return docs.select("*", F.explode_outer(F.when(F.col("at") >= 0, each)
                                            .otherwise(F.array(F.lit(None).cast("long")))).alias("hash"))


def _blocks(table: DataFrame, key: str, block: int) -> list[DataFrame]:
    """``table`` in blocks of about ``block`` rows, by ``key``."""
    n = max(1, math.ceil(table.count() / block))
    return [table if n == 1 else table.filter(F.pmod(F.hash(key), F.lit(n)) == i) for i in range(n)]


def prefixes(documents: DataFrame, windows: DataFrame, widths: list[int], least: float = LEAST,
             block: int = BLOCK) -> DataFrame:
    """``window, words, size, width, need, place, hash``: the rarest shingles of each window, as many as necessary."""
    spots = windows.select("window", "words", "size", "width", _shingles(windows, widths))
    hashes = materialize(spots.select("hash").distinct(), "shingles")
    counts = None
    for part in _blocks(hashes, "hash", block):
        found = (_positions(documents, widths, False).select("hash")
                 .join(F.broadcast(part), "hash").groupBy("hash").agg(F.count(F.lit(1)).alias("n")))
        counts = found if counts is None else counts.unionByName(found)
    total = F.col("size") - F.col("width") + 1
    need = F.ceil(total * F.lit(least) - 1e-9).cast("int")
    rarity = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "hash", "place")
    return (spots.join(counts, "hash", "left").withColumn("need", need)
            .withColumn("rank", F.row_number().over(rarity))
            .filter((F.col("rank") <= total - F.col("need") + 1) & F.col("n").isNotNull())
            .drop("rank", "n"))


def benchmark_hits(documents: DataFrame, items: DataFrame, words: int = WORDS, shingle: int = SHINGLE,
                   least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """Per document ``doc_id, text_key, n_words, spans`` (first and last word of each hit run) and ``item_ids``."""
    pairs = materialize(item_windows(items, words, shingle), "item-windows")
    # the id of a window is that of the table written here
    windows = materialize(pairs.select("words", "size", "width").distinct()
                          .withColumn("window", F.monotonically_increasing_id()), "windows")
    of_items = pairs.join(windows, ["words", "size", "width"]).select("window", "item_id")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect()) or [1]  # at most `shingle` rows
    tokens = materialize(prefixes(documents, windows, widths, least, block), "prefixes")

    start = F.col("at") - F.col("place")
    run = F.slice("d.words", start + 1, F.col("size"))
    if least >= 1:
        same = F.array_join(run, " ") == F.array_join("w.words", " ")
    else:
        equal = F.zip_with(run, "w.words", lambda a, b: a == b)
        hits = F.filter(F.sequence(F.lit(0), F.col("size") - F.col("width")),
                        lambda i: F.forall(F.slice(equal, i + 1, F.col("width")), lambda e: e))
        same = F.size(hits) >= F.col("need")
    found = None
    for number, part in enumerate(_blocks(tokens, "hash", block)):
        spots = _positions(documents, widths, number == 0).alias("d")
        on = ((F.col("d.hash") == F.col("w.hash")) & (start >= 0)
              & (start + F.col("size") <= F.size("d.words")) & same)
        at = spots.join(F.broadcast(part.alias("w")), on, "left" if number == 0 else "inner")
        at = at.filter((F.col("at") == -1) | F.col("window").isNotNull()).select(
            "doc_id", "text_key", "window", F.when(F.col("at") == -1, F.size("d.words")).alias("n"),
            F.when(F.col("window").isNotNull(), F.struct(start.alias("first"), (start + F.col("size") - 1).alias("last")))
            .alias("span"))
        found = at if found is None else found.unionByName(at)
    # a document's rows meet before they are shuffled
    row = ["doc_id", "text_key"]
    docs = materialize(found.groupBy(*row).agg(
        F.count("n").alias("copies"), F.max("n").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("window").alias("windows")), "hits")
    hit = F.size("windows") > 0
    listed = (docs.filter(hit).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"),
                                      F.explode("windows").alias("window")).join(of_items, "window")
              .groupBy("id", "key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    same_row = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    dirty = docs.filter(hit).join(listed, same_row, "left").select(*docs.columns, "item_ids")
    none = F.array().cast("array<string>")
    return (docs.filter(~hit).withColumn("item_ids", none)
            .unionByName(dirty.withColumn("item_ids", F.coalesce("item_ids", none)))
            .select(*row, F.col("n_words").cast("long").alias("n_words"), "spans", "item_ids",
                    F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy"))



def hit_words(spans: Column) -> Column:
    """How many words lie in any of the ``spans``, which are sorted."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end"))

    def step(state: Column, span: Column) -> Column:
        new = F.greatest(span["last"] - F.greatest(span["first"] - 1, state["end"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["end"], span["last"]).alias("end"))

    return F.aggregate(spans, start, step, lambda state: state["n"])


def contamination(documents: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    n_hit = hit_words(F.col("spans"))
    return (benchmark_hits(documents, items, words)
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


CONTAMINATION_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (
        SELECT CAST(item_id AS VARCHAR) AS item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s + 1:s + 10], ' ') AS text
        FROM (SELECT item_id, w, unnest(generate_series(0, greatest(len(w) - 10, 0))) AS s FROM i WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT size FROM windows),
    runs AS (
        SELECT r, size, s, array_to_string(w[s + 1:s + size], ' ') AS text
        FROM (SELECT r, w, size, unnest(generate_series(0, len(w) - size)) AS s FROM d, sizes WHERE len(w) >= size)),
    hits AS (SELECT r, s, runs.size, item_id FROM runs JOIN windows ON runs.size = windows.size AND runs.text = windows.text),
    words AS (SELECT r, count(DISTINCT p) AS n_hit
              FROM (SELECT r, unnest(generate_series(s, s + size - 1)) AS p FROM hits) GROUP BY r),
    ids AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
            FROM hits GROUP BY r)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)"""
