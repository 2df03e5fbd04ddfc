"""Operator 13: phrase collocations mined through Rabin-Karp fingerprints.

Texts are cut at punctuation and line ends into pieces and those into words. A
word's hash comes from prefix polynomials over its batch's bytes, and an
n-gram's fingerprint from prefix polynomials over the word hashes (differences
of two prefixes, times an inverse power; arithmetic modulo 2**64), so every
n-gram costs a few numpy operations whatever its length.

1. Sieve: all n-grams are counted by the first ``SIEVE_BITS`` bits of their
   fingerprints. One in a place with fewer than ``least`` occurrences cannot be
   frequent. The sieve is a bit map of that fixed size; more data fill it more
   and sieve less, and lose nothing.
2. Occurrences: what is left is counted by fingerprint within a batch, where
   each fingerprint keeps the first occurrence as a pointer (document, place,
   length); the others' words are compared with its bytes, and those that
   differ are counted by themselves. Between batches, a fingerprint goes with a
   check, a polynomial over the same bytes modulo a prime: counts are added up
   only where both are equal, and one pointer is kept.
3. The pointers of what reaches ``least`` go to their documents, and only there
   the phrase is cut out of the text and its fingerprint worked out anew.

The empty phrase is counted with the others; its occurrences are the words of
the language. Scores, cuts and ranks are column expressions on the frequent
phrases (every part of a frequent phrase is one).

Defined results: a null text is empty; a null language is ``und`` and counted
with texts of that language; rows that repeat an id or a text count each; null
ids play no part; an empty table gives an empty result; further columns are
ignored. Words longer than a batch, and texts of any length, are taken whole.
Phrases of different batches count as one if 64 bits of fingerprint and 31 of
check agree. Pointers name a text by a 64-bit hash of it and its language;
should two texts share one, some phrase lacks its fingerprint and the job fails.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadlens.llm.common import slices, text_bytes, texts
from roadlens.session import materialize

MOST_WORDS, LEAST, COVERED, TOP, TOP_PARTS = 3, 10, 50, 2000, 16
SIEVE_BITS = 28
SIEVE_RANGES, SIEVED_AT_ONCE = 1 << 12, 8_000_000
BATCH_BYTES, PART_BYTES = 4 << 20, 1 << 20
KEPT_COUNTS = 1_100_000  # that a task holds before it sends them on
LEAST_RANGES = 1024  # of fingerprints

_RANDOM = np.random.default_rng(20_240_613)
#: A value for each byte, and the odd bases of the two polynomials.
BYTE_VALUES = _RANDOM.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: The same for the check, modulo a prime.
PRIME = 2 ** 31 - 1
CHECK_VALUES = _RANDOM.integers(1, PRIME, 256, dtype=np.int64)
CHECK_BYTE_BASE, CHECK_WORD_BASE = 1_103_515_245, 1_664_525
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD, SPACE, BREAK = 0, 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = SPACE
KINDS[[*b".,;:!?\n\x0b\x0c\r"]] = BREAK


class Powers:
    """Powers of a base and of its inverse modulo 2**64 or a prime, as many as were asked for so far."""

    def __init__(self, base: int, modulus: int = 2 ** 64):
        self.bases, self.modulus, self.tables = (base, pow(base, -1, modulus)), modulus, None

    def _powers(self, base: int, n: int) -> np.ndarray:
        if self.modulus == 2 ** 64:
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)
        out = np.ones(1, np.int64)
        while len(out) < n:
            out = np.concatenate([out, out * pow(base, len(out), self.modulus) % self.modulus])
        return out

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.tables is None or len(self.tables[0]) < n:
            self.tables = tuple(self._powers(base, max(n, 1)) for base in self.bases)
        return self.tables[0][:n], self.tables[1][:n]


BYTE_POWERS, WORD_POWERS = Powers(BYTE_BASE), Powers(WORD_BASE)
CHECK_POWERS = Powers(CHECK_BYTE_BASE, PRIME)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seed_of(lang: str) -> np.uint64:
    return mixed(_polynomial(np.frombuffer(lang.encode("utf-8") + b"\0", np.uint8).astype(np.uint64), BYTE_POWERS)[-1:])[0]


def _polynomial(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``, the empty prefix first."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers.first(len(values))[0], out=out[1:])
    return out


class Words:
    """The words of texts that lie one after another in ``data``: where they start, their lengths, pieces and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        inside = KINDS[data] == WORD
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # a word ends with its text
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        self.starts = np.flatnonzero(after & (~before | edge))
        self.lengths = np.flatnonzero(before & (~after | edge)) - self.starts
        breaks = np.flatnonzero(KINDS[data] == BREAK)
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        self.piece = np.searchsorted(breaks, self.starts) + self.text
        self.hashes = self._hashes()

    def _parts(self):
        """Runs of words that span about ``PART_BYTES``, one word at least."""
        first = 0
        while first < len(self.starts):
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + PART_BYTES)))
            yield first, last
            first = last

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), np.uint64)
        for first, last in self._parts():
            at = self.starts[first]
            s, n = self.starts[first:last] - at, self.lengths[first:last]
            values = BYTE_VALUES[self.data[at:at + s[-1] + n[-1]]]
            prefix = _polynomial(values, BYTE_POWERS)
            out[first:last] = mixed((prefix[s + n] - prefix[s]) * BYTE_POWERS.first(len(values))[1][s])
        return out

    def checks(self) -> np.ndarray:
        """The words' checks."""
        out = np.zeros(len(self.starts), np.int64)
        for first, last in self._parts():
            at = self.starts[first]
            s, n = self.starts[first:last] - at, self.lengths[first:last]
            bytes_ = self.data[at:at + s[-1] + n[-1]]
            up, down = CHECK_POWERS.first(len(bytes_))
            # below 2**31 each, so a part's sum stays below 2**63
            prefix = np.append(0, np.cumsum(CHECK_VALUES[bytes_] * up % PRIME))
            out[first:last] = (prefix[s + n] - prefix[s]) % PRIME * down[s] % PRIME
        return out

    def ids(self) -> np.ndarray:
        """One number for each distinct word, by its bytes: equal hashes are compared with their first occurrence."""
        _, first, ids = np.unique(self.hashes, return_index=True, return_inverse=True)
        same = self.lengths == self.lengths[first[ids]]
        for low, high in self._parts():
            n = np.where(same[low:high], self.lengths[low:high], 0)
            ends = np.cumsum(n)
            inner = np.arange(ends[-1]) - np.repeat(ends - n, n)
            here = np.repeat(self.starts[low:high], n) + inner
            there = np.repeat(self.starts[first[ids[low:high]]], n) + inner
            differ = np.flatnonzero(self.data[here] != self.data[there])
            same[low + np.searchsorted(ends, differ, side="right")] = False
        others: dict[bytes, int] = {}
        for w in np.flatnonzero(~same):  # hashes that collide
            s, n = self.starts[w], self.lengths[w]
            ids[w] = others.setdefault(self.data[s:s + n].tobytes(), len(first) + len(others))
        return ids

    def grams(self, n: int) -> np.ndarray:
        """The first words of all n-grams."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:len(self.piece) - n + 1] == self.piece[n - 1:])

    def prints(self, at: np.ndarray, n: int, seed: np.uint64, prefix: np.ndarray, print_bits: int) -> np.ndarray:
        """Fingerprints of the n-grams that start at the words ``at``; fewer than 64 ``print_bits`` make them collide."""
        down = WORD_POWERS.first(len(self.hashes) + 1)[1]
        whole = mixed(((prefix[at + n] - prefix[at]) * down[at]) ^ seed ^ np.uint64(n))
        return whole >> np.uint64(64 - print_bits) << np.uint64(64 - print_bits)

    def prefix(self) -> np.ndarray:
        return _polynomial(self.hashes, WORD_POWERS)


def _batches(batches):
    """Texts of one language, about ``BATCH_BYTES`` at a time: (language, their bytes and offsets, the rows)."""
    kept, size = [], 0

    def flush():
        table = pa.Table.from_batches(kept)
        langs = table.column("lang").to_numpy()
        for lang in dict.fromkeys(langs):
            own = table.filter(pa.array(langs == lang)).combine_chunks()
            yield lang, text_bytes(texts(own.to_batches()[0])), own

    for batch in batches:
        for part in slices(batch, BATCH_BYTES):
            kept.append(part)
            size += len(text_bytes(texts(part))[0])
            if size >= BATCH_BYTES:
                yield from flush()
                kept, size = [], 0
    if kept:
        yield from flush()


def _bucket(prints: np.ndarray, bits: int) -> np.ndarray:
    return (prints >> np.uint64(64 - bits)).astype(np.uint32)


def _packed(numbers: np.ndarray, rising: bool) -> bytes:
    """Numbers byte by byte of their width, so that leading zeros lie together; rising ones as differences."""
    if rising:
        numbers = np.diff(numbers, prepend=numbers.dtype.type(0))
    return zstandard.compress(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes(), 1)


def _unpacked(cell: pa.Scalar, kind: type, rising: bool) -> np.ndarray:
    raw = zstandard.decompress(cell.as_buffer())
    numbers = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()
    return np.cumsum(numbers, dtype=kind) if rising else numbers


def _by_range(ranges: np.ndarray, columns: dict[str, np.ndarray], group: int = 0):
    """A row per range of entries that come in order of their ranges and, within, of the first column."""
    names, first = np.unique(ranges, return_index=True)
    ends = np.append(first[1:], len(ranges))
    for low in range(0, len(names), 256):
        own = slice(low, low + 256)
        cells = [pa.array([_packed(column[a:b], i == 0) for a, b in zip(first[own], ends[own])], pa.binary())
                 for i, column in enumerate(columns.values())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[own].astype(np.int32)), pa.array(np.full(len(names[own]), group)), *cells],
            names=["range", "task", *columns])


def _ranges(batches, types: dict[str, type]):
    """The unpacked columns of one range after the other, and the task of each entry; rows come in order of their ranges."""
    at, kept = None, None
    for batch in batches:
        numbers, tasks = batch.column("range").to_numpy(), batch.column("task").to_numpy()
        cells = {name: batch.column(name) for name in types}
        for i, number in enumerate(numbers):
            if number != at:
                if kept:
                    yield at, {n: np.concatenate(x) for n, x in kept.items()}
                at, kept = number, {name: [] for name in (*types, "task")}
            for j, (name, kind) in enumerate(types.items()):
                kept[name].append(_unpacked(cells[name][i], kind, j == 0))
            kept["task"].append(np.full(len(kept[name][-1]), tasks[i]))
    if kept:
        yield at, {n: np.concatenate(x) for n, x in kept.items()}


def _sieve_shape(bits: int) -> tuple[int, int]:
    """Ranges of the sieve, and places of each."""
    ranges = min(SIEVE_RANGES, 1 << bits)
    return ranges, (1 << bits) // ranges


def sieve(docs: DataFrame, most: int, least: int, bits: int, print_bits: int = 64) -> np.ndarray:
    """Which places hold ``least`` n-grams or more, a bit each."""
    ranges, inner = _sieve_shape(bits)
    types = {"place": np.uint16 if inner <= 1 << 16 else np.uint32, "n": np.uint8 if least < 256 else np.uint32}

    def packed(kept: list[np.ndarray]):
        bucket = np.sort(np.concatenate(kept))
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
        times = np.minimum(np.diff(np.append(first, len(bucket))), least)
        bucket = bucket[first]
        yield from _by_range(bucket // np.uint32(inner), {"place": (bucket % np.uint32(inner)).astype(types["place"]),
                                               "n": times.astype(types["n"])})

    def count(batches):
        kept, size = [], 0
        for lang, (data, offsets), _ in _batches(batches):
            words, seed = Words(data, offsets), seed_of(lang)
            prefix = words.prefix()
            for n in range(1, most + 1):
                kept.append(_bucket(words.prints(words.grams(n), n, seed, prefix, print_bits), bits))
                size += len(kept[-1])
            if size >= SIEVED_AT_ONCE:
                yield from packed(kept)
                kept, size = [], 0
        if kept:
            yield from packed(kept)

    def add(batches):
        for number, own in _ranges(batches, types):
            full = np.bincount(own["place"], own["n"], inner) >= least
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([np.packbits(
                full, bitorder="little").tobytes()], pa.binary())], names=["range", "bits"])

    rows = (docs.select("lang", "text").mapInArrow(count, "range int, task long, place binary, n binary")
            .repartition("range").sortWithinPartitions("range").mapInArrow(add, "range int, bits binary")).toArrow()
    out = np.zeros((ranges, max(inner // 8, 1)), np.uint8)  # 2 ** bits / 8 bytes, whatever the input
    for number, cell in zip(rows.column("range").to_pylist(), rows.column("bits").to_pylist()):
        out[number] = np.frombuffer(cell, np.uint8)
    return out


def _in_sieve(bits_set: np.ndarray, bucket: np.ndarray, bits: int) -> np.ndarray:
    inner = np.uint32(_sieve_shape(bits)[1])
    place = bucket % inner
    return (bits_set[bucket // inner, place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def batch_counts(words: Words, lang: str, most: int, bits_set: np.ndarray, bits: int, print_bits: int = 64):
    """(fingerprint, check, count, first word, words) of a batch's n-grams that pass the sieve, n from 1 to ``most``.

    An n-gram that shares its fingerprint with another one's first occurrence has a row of its own.
    """
    seed, prefix, ids, checks = seed_of(lang), words.prefix(), words.ids(), words.checks()
    passes = None  # whether the shorter n-gram that starts at a word did
    for n in range(1, most + 1):
        at = words.grams(n)
        if n > 1:
            at = at[passes[at] & passes[at + 1]]
        prints = words.prints(at, n, seed, prefix, print_bits)
        keep = _in_sieve(bits_set, _bucket(prints, bits), bits)
        at, prints = at[keep], prints[keep]
        if not len(at):
            return
        passes = np.zeros(len(ids) + 1, bool)
        passes[at] = True
        values, first, group = np.unique(prints, return_index=True, return_inverse=True)
        pointer = at[first]
        same = np.logical_and.reduce([ids[at + i] == ids[pointer[group] + i] for i in range(n)])
        odd = np.flatnonzero(~same)
        counts = np.append(np.bincount(group[same], minlength=len(values)), np.ones(len(odd), np.int64))
        pointer = np.append(pointer, at[odd])
        check = np.full(len(pointer), (int(seed) + n) % PRIME)
        for i in range(n):
            check = (check * CHECK_WORD_BASE + checks[pointer + i]) % PRIME
        yield np.append(values, prints[odd]), check, counts, pointer, n


#: A count between tasks. A pointer is a row of its task's documents, and the phrase's first byte there and length.
COUNT = {"prints": np.uint64, "check": np.int32, "n": np.int64, "row": np.int32, "at": np.int32, "length": np.int32}


def _added(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts by fingerprint and check, in order of the fingerprint, with the first pointer of each."""
    keys = [counts[c] for c in ("at", "row", "task", "check", "prints") if c in counts]
    order = np.lexsort(keys)
    prints, check = counts["prints"][order], counts["check"][order]
    first = np.flatnonzero(np.append(True, (prints[1:] != prints[:-1]) | (check[1:] != check[:-1])))
    out = {name: values[order[first]] for name, values in counts.items()}
    out["n"] = np.add.reduceat(counts["n"][order], first)
    return out


def occurrences(docs: DataFrame, most: int, bits_set: np.ndarray, bits: int, print_bits: int, ranges: int) -> DataFrame:
    """Fingerprints' counts, checks and pointers, a task's packed by range of the fingerprint.

    What a task sends on at once has a number, made of its documents' keys, and a row with these keys.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits_set)
    step = np.uint64(-(-2 ** 64 // ranges))

    def batch(lang: str, data: np.ndarray, offsets: np.ndarray, before: int):
        words = Words(data, offsets)
        if not len(words.starts):
            return
        # the empty phrase, which occurs once a word
        seed = seed_of(lang)
        none = (seed.reshape(1), np.array([int(seed) % PRIME]), np.array([len(words.starts)]), np.zeros(1, np.int64), 0)
        for prints, check, n, first, size in [none, *batch_counts(words, lang, most, shared.value, bits, print_bits)]:
            text, last = words.text[first], first + max(size, 1) - 1
            start = words.starts[first]
            length = words.starts[last] + words.lengths[last] - start if size else np.zeros(1, np.int64)
            found = (prints, check, n, text + before, start - offsets[text], length)
            yield {name: x.astype(kind) for x, (name, kind) in zip(found, COUNT.items())}

    def sent(counts: dict[str, np.ndarray], keys: list[np.ndarray]):
        keys = np.concatenate(keys)
        task = int(mixed(_polynomial(keys.view(np.uint64), WORD_POWERS)[-1:]).view(np.int64)[0])
        nothing = [pa.array([b""], pa.binary())] * len(COUNT)
        yield pa.RecordBatch.from_arrays([pa.array([task % ranges], pa.int32()), pa.array([task]), *nothing,
                                          pa.array([keys.tobytes()], pa.binary())], names=["range", "task", *COUNT, "docs"])
        for rows in _by_range(counts["prints"] // step, {name: counts[name] for name in COUNT}, task):
            yield rows.append_column("docs", pa.nulls(rows.num_rows, pa.binary()))

    def count(batches):
        kept, keys, size, docs_kept = [], [], 0, 0

        def added():
            return _added({name: np.concatenate([k[name] for k in kept]) for name in COUNT})

        for lang, (data, offsets), rows in _batches(batches):
            for found in batch(lang, data, offsets, docs_kept):
                kept.append(found)
                size += len(found["n"])
            keys.append(rows.column("doc").to_numpy())
            docs_kept += len(keys[-1])
            if size >= KEPT_COUNTS:
                kept = [added()]
                size = len(kept[0]["n"])
                if 2 * size >= KEPT_COUNTS:  # little is left to add up
                    yield from sent(kept[0], keys)
                    kept, keys, size, docs_kept = [], [], 0, 0
        if kept:
            yield from sent(added(), keys)

    schema = ", ".join(["range int, task long", *[f"{name} binary" for name in COUNT], "docs binary"])
    return docs.select("lang", "text", "doc").mapInArrow(count, schema)


def frequent(found: DataFrame, least: int) -> DataFrame:
    """``doc, pointers``: the documents' pointers to what occurs ``least`` times or more, one for each such phrase."""
    names = ["task", "row", "at", "length", "print", "n", "doc"]

    def add(batches):
        def counts():
            for rows in batches:
                for i in np.flatnonzero(rows.column("docs").is_valid().to_numpy(zero_copy_only=False)):
                    keys = np.frombuffer(rows.column("docs")[int(i)].as_buffer(), np.int64)
                    lists.append((rows.column("task")[int(i)].as_py(), keys))
                yield rows.filter(rows.column("docs").is_null())

        lists: list[tuple[int, np.ndarray]] = []
        for _, own in _ranges(counts(), COUNT):
            own = _added(own)
            keep = own["n"] >= least
            own["print"] = own["prints"].view(np.int64)
            yield pa.RecordBatch.from_arrays([*[pa.array(own[name][keep]) for name in names[:-1]],
                                              pa.nulls(int(keep.sum()), pa.int64())], names=names)
            while lists:
                yield listed(*lists.pop())
        while lists:
            yield listed(*lists.pop())

    def listed(task: int, keys: np.ndarray) -> pa.RecordBatch:
        rows = np.arange(len(keys), dtype=np.int32)
        nothing = [pa.nulls(len(keys), kind) for kind in (pa.int32(), pa.int32(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), task)), pa.array(rows), *nothing, pa.array(keys)],
                                          names=names)

    pointer = F.when(F.col("doc").isNull(), F.struct("at", "length", "print", "n"))
    return (found.repartition("range").sortWithinPartitions("range")
            .mapInArrow(add, "task long, row int, at int, length int, print long, n long, doc long")
            .groupBy("task", "row").agg(F.max("doc").alias("doc"), F.collect_list(pointer).alias("pointers"))
            .filter(F.size("pointers") > 0).select("doc", "pointers"))


def _phrases(print_bits: int):
    """Cut the phrases that pointers name out of their texts, and hold them against the fingerprints."""
    def cut(batches):
        for batch in batches:
            for part in slices(batch, BATCH_BYTES // 4):
                data, offsets = text_bytes(texts(part))
                lists = part.column("pointers")
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                at, length, prints = (flat.field(c).to_numpy() for c in ("at", "length", "print"))
                out = [_phrase(data[s:s + n]) for s, n in zip(offsets[row] + at, length)]
                phrases, langs = pa.array(out, pa.string()), part.column("lang").take(pa.array(row))
                if not np.array_equal(_prints_of(phrases, langs, print_bits), prints.view(np.uint64)):
                    raise ValueError("two texts share a key")
                yield pa.RecordBatch.from_arrays([langs, phrases, flat.field("n")], names=["lang", "phrase", "n"])

    return cut


def _prints_of(phrases: pa.StringArray, langs: pa.StringArray, print_bits: int) -> np.ndarray:
    """The phrases' fingerprints."""
    words = Words(*text_bytes(phrases))
    n = np.bincount(words.text, minlength=len(phrases))
    first, prefix = np.cumsum(n) - n, words.prefix()
    langs = langs.to_numpy(zero_copy_only=False)
    out = np.zeros(len(phrases), np.uint64)
    for lang in dict.fromkeys(langs):
        for size in np.unique(n[langs == lang]):
            own = np.flatnonzero((langs == lang) & (n == size))
            out[own] = words.prints(first[own], size, seed_of(lang), prefix, print_bits) if size else seed_of(lang)
    return out


def _phrase(raw: np.ndarray) -> str:
    """The words of a phrase's bytes, A-Z in lower case, with one space between them."""
    return " ".join(w.decode("utf-8") for w in LOWER[raw].tobytes().replace(b"\t", b" ").split(b" ") if w)


def phrase_counts(documents: DataFrame, most: int = MOST_WORDS, least: int = LEAST, bits: int = SIEVE_BITS,
                  print_bits: int = 64) -> DataFrame:
    """``lang, phrase, n`` of all phrases of up to ``most`` words with ``least`` occurrences; the phrase '' counts words."""
    docs = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.filter(F.col("text") != "").withColumn("doc", F.xxhash64("lang", "text"))
    ranges = max(LEAST_RANGES, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = occurrences(docs, most, sieve(docs, most, least, bits, print_bits), bits, print_bits, ranges)
    whole = docs.groupBy("doc").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))  # equal texts once
    return (whole.join(frequent(found, least), "doc").select("lang", "text", "pointers")
            .mapInArrow(_phrases(print_bits), "lang string, phrase string, n long"))


def _exact(column: str) -> Column:
    return F.col(column).cast(T.DecimalType(16, 0))


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` by the cut with the lowest score."""
    cuts = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("words", 1, k), " ").alias("left"),
        F.array_join(F.slice("words", k + 1, F.size("words")), " ").alias("right")))
    cut = candidates.select("lang", "phrase", "a", F.inline(cuts))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    score = F.call_function("div", _exact("a") * _exact("a") * F.lit(1_000_000).cast(T.DecimalType(7, 0)),
                            _exact("l") * _exact("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(documents: DataFrame, most: int = MOST_WORDS, least: int = LEAST, covered: int = COVERED,
                 top: int = TOP, bits: int = SIEVE_BITS, print_bits: int = 64) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    counts = materialize(phrase_counts(documents, most, least, bits, print_bits), "phrases")
    words = F.col("phrase") != ""
    candidates = (counts.filter(words).withColumn("words", F.split("phrase", " ")).filter(F.size("words") >= 2)
                  .withColumnRenamed("n", "a"))
    # the most frequent longer candidate that a phrase lies in
    lengths = F.sequence(F.lit(2), F.size("words") - 1)
    inner = F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: F.array_join(F.slice("words", i, k), " "))))
    longer = (candidates.filter(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("in_longer")))
    open_ = (candidates.join(longer, ["lang", "phrase"], "left")
             .filter(100 * F.coalesce("in_longer", F.lit(0)) < covered * F.col("a")))
    totals = counts.filter(~words).select("lang", F.col("n").alias("n"))
    # first within each language's parts, so that the last sort holds no more than the parts' best
    order = [F.desc("score"), F.desc("a"), "phrase"]
    scored = _scored(open_, counts).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(*order)
        scored = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return (scored.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


COLLOCATIONS_SQL = r"""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
    sizes AS (SELECT unnest([1, 2, 3]) AS size),
    grams AS (SELECT lang, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
              FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s
                    FROM p, sizes WHERE len(w) >= size)),
    f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY lang, size, phrase),
    totals AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND a >= 10),
    cuts AS (
        SELECT c.lang, c.phrase, c.size, c.a, k, l.a AS l, r.a AS r,
               CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS score
        FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (
        SELECT lang, phrase, max(a) AS a FROM (
            SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE size = 3
            UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE size = 3) GROUP BY lang, phrase),
    ranked AS (
        SELECT x.lang, x.phrase, x.a, x.l, x.r, x.score,
               row_number() OVER (PARTITION BY x.lang ORDER BY x.score DESC, x.a DESC, x.phrase) AS rank
        FROM lowest x LEFT JOIN longer y ON x.lang = y.lang AND x.phrase = y.phrase
        WHERE 100 * coalesce(y.a, 0) < 50 * x.a)
    SELECT ranked.lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN totals ON ranked.lang = totals.lang WHERE rank <= 2000"""
