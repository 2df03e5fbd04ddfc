"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The white space of the contracts, ``[\x20\x09-\x0D]``.
WHITESPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_bucket(column: str, buckets: int) -> Column:
    """``crc32(column as text) mod buckets``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % buckets


def text_key() -> Column:
    """Half of a row's identity, beside ``doc_id``: a hash of its whole text (null: empty)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.StringArray:
    """A batch's texts as one string array; null counts as empty."""
    array = batch.column(column)
    if not pa.types.is_string(array.type):
        array = array.cast(pa.string())
    return array.fill_null("") if array.null_count else array


def text_bytes(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string array without nulls; no copy."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    end = int(offsets[-1]) if len(offsets) else 0
    return whole[base:end], offsets.astype(np.int64) - base


def slices(batch: pa.RecordBatch, max_bytes: int, column: str = "text"):
    """Cut a batch into runs of rows of about ``max_bytes`` of text (one row at least)."""
    array = texts(batch, column)
    _, offsets = text_bytes(array)
    start = 0
    while start < len(array):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def spare(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` keeps, with the columns of ``docs``.

    ``verdict`` has one row per distinct (``doc_id``, ``text_key``) of
    ``docs``: ``kept`` and ``copies``, the number of rows with that id and
    text. What goes is matched by an anti join (Spark broadcasts a short
    list and shuffles a long one). Of a kept id and text that several rows
    repeat, one row stays: the smallest by its other columns.
    """
    key = ["doc_id", "text_key"]

    def matched(how: str, keys: DataFrame) -> DataFrame:
        on = docs["doc_id"].eqNullSafe(keys["doc_id"]) & (text_key_of(docs) == keys["text_key"])
        return docs.join(keys, on, how)

    gone = verdict.filter(~F.col("kept") | (F.col("copies") > 1)).select(*key)
    repeated = verdict.filter(F.col("kept") & (F.col("copies") > 1)).select(*key)
    order = [F.hash(F.to_json(F.struct(*docs.columns))), *docs.columns] if docs.columns else []
    first = Window.partitionBy("doc_id", text_key()).orderBy(*order)
    rank = spare(docs.columns, "rank_of_copy")
    one = matched("left_semi", repeated).withColumn(rank, F.row_number().over(first))
    return (matched("left_anti", gone)
            .unionByName(one.filter(F.col(rank) == 1).drop(rank))
            .select(*docs.columns))


def text_key_of(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))
