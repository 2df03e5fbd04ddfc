"""String expressions: id padding, emptiness, ``k=v|k=v`` records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadlens.functions._col import as_col


def pad_id(text: str | Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; never truncates a longer id."""
    s = as_col(text)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def pad2(text: str | Column) -> Column:
    """Two-digit padding that only touches one-character values."""
    s = as_col(text)
    return F.when(F.length(s) == 1, F.concat(F.lit("0"), s)).otherwise(s)


def is_empty(text: str | Column) -> Column:
    return F.coalesce(as_col(text), F.lit("")) == ""


def is_not_empty(text: str | Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: str | Column) -> Column:
    """Drop at most one leading and one trailing comma."""
    return F.regexp_replace(as_col(text), r"^,|,\z", "")


def _fields(record: Column) -> Column:
    # Splitting drops trailing empty pieces, so strip trailing separators first.
    return F.split(F.regexp_replace(record, r"\|+\z", ""), r"\|")


def _pair(field: Column) -> Column:
    return F.split(F.regexp_replace(field, r"=+\z", ""), "=")


def kv_field(record: str | Column, key: str) -> Column:
    """Value of the first ``key=value`` piece of a ``k=v|k=v`` record.

    Pieces that do not split into exactly two parts are skipped; null when
    the key is absent.
    """
    pairs = F.transform(_fields(as_col(record)), _pair)
    hits = F.filter(pairs, lambda p: (F.size(p) == 2) & (F.get(p, 0) == F.lit(key)))
    return F.get(F.get(hits, 0), 1)


def kv_set_field(record: str | Column, key: str, value: str | Column) -> Column:
    """Replace the value of the first piece named ``key``; rejoin with ``|``."""
    fields = _fields(as_col(record))
    names = F.transform(fields, lambda f: F.get(F.split(f, "="), 0))
    first = F.array_position(names, key)  # 1-based, 0 when absent
    new_piece = F.concat(F.lit(key), F.lit("="), as_col(value) if not isinstance(value, str) else F.lit(value))
    replaced = F.transform(fields, lambda f, i: F.when(i + 1 == first, new_piece).otherwise(f))
    return F.array_join(replaced, "|")


def kv_map(record: str | Column) -> Column:
    """All well-formed pieces as a map; a repeated key keeps its last value."""
    pairs = F.filter(F.transform(_fields(as_col(record)), _pair), lambda p: F.size(p) == 2)
    # keep a pair only when no later pair has the same key
    indexed = F.transform(pairs, lambda p, i: F.struct(F.get(p, 0).alias("k"), F.get(p, 1).alias("v"), i.alias("i")))
    last = F.filter(indexed, lambda e: ~F.exists(
        indexed, lambda o: (o["k"] == e["k"]) & (o["i"] > e["i"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))
