"""Operator 6: mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

A source's documents, in a hashed order, form blocks of ``block`` documents.
Its k-th block is released at ``floor(k / w)`` and due at ``ceil((k + 1) / w)``
for its weight ``w``; in each slot the released block that is due first goes
out (ties: the source named first). Weights are exact fractions, as they are
written, of any common denominator. At any slot, a source is less than one
block away from its weight's share of the slots.

Where a source runs out, a new phase begins: the others go on with the weights
that are left, from a share of nothing. There are at most as many phases as
sources, and a phase has no empty slot, so there are as many slots as blocks.

A phase's schedule repeats after a period of ``sum of whole parts`` slots. It
is worked out for one period or, if that is longer than the phase can be, for
the slots of the phase: in windows of ``WINDOW`` slots, each an ``aggregate``
that starts from the blocks gone so far, written to a table. The slot of any
block, and the blocks before any slot, follow by arithmetic from that table.
Every document has exactly one place; none is dropped or repeated.

Sources without a weight (nulls too) form one more stream with ``rest``.
The documents of a source are ranked in ``BUCKETS`` hash buckets, with a
running count of the buckets' sizes, so no task ranks a whole source. Tables
that are broadcast: the buckets' (``BUCKETS * (sources + 1)`` rows), the
phases', and the schedule while it has ``BROADCAST_CELLS`` numbers at most.

Defined results: documents with a null id are placed like any other; repeated
rows have a place each, rows that repeat an id are ordered by their other
columns; an empty table gives an empty result; further columns pass through,
but for those named like the results, which are replaced. Weights that have no
whole parts of ``1 / FINEST`` of their sum are refused, not rounded.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadlens.session import scratch_path

BLOCK, WINDOW, BUCKETS, SEED = 16, 8192, 1024, 42
BROADCAST_CELLS = 2_000_000
FINEST = 2 ** 61


def exact_parts(weights: dict[str, float], rest: float) -> list[int]:
    """The weights, ``rest`` last, in whole parts without rounding."""
    shares = [Fraction(str(w)) for w in (*weights.values(), rest)]
    if any(w <= 0 for w in shares):
        raise ValueError("weights are positive")
    whole = math.lcm(*[w.denominator for w in shares])
    parts = [int(w * whole) for w in shares]
    parts = [p // math.gcd(*parts) for p in parts]
    if sum(parts) >= FINEST:
        raise ValueError("weights have parts below 1 / 2 ** 61 of their sum")
    return parts


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def slot_window(parts: Column, size: Column, lag: Column, done: Column, slots: int) -> Column:
    """``stream, nth, before`` of the next ``slots`` slots, by earliest deadline among released blocks.

    ``lag`` is what each stream is owed, in parts of a block of ``size`` parts:
    its block is released in this slot if ``lag + part > 0``, and due in
    ``ceil((size - lag) / part)`` slots. ``done`` are the blocks gone so far; a
    stream with no part takes no slot.
    """
    indices = F.sequence(F.lit(0), F.size(parts) - 1)

    def step(state: Column, _: Column) -> Column:
        def due(i: Column) -> Column:
            owed, part = F.get(state["lag"], i), F.get(parts, i)
            left = F.call_function("div", size - owed + part - F.lit(1), part)
            return F.when((part > 0) & (owed + part > 0), F.struct(left.alias("left"), i.alias("stream")))

        chosen = F.array_min(F.transform(indices, due))["stream"]
        lag = F.transform(state["lag"], lambda x, i: x + F.get(parts, i) - F.when(i == chosen, size).otherwise(0))
        gone = F.transform(state["done"], lambda n, i: n + F.when(i == chosen, 1).otherwise(0).cast("long"))
        row = F.struct(chosen.alias("stream"), F.get(state["done"], chosen).alias("nth"), state["done"].alias("before"))
        return F.struct(lag.alias("lag"), gone.alias("done"), F.concat(state["order"], F.array(row)).alias("order"))

    empty = F.array().cast("array<struct<stream:int,nth:bigint,before:array<bigint>>>")
    start = F.struct(lag.alias("lag"), done.alias("done"), empty.alias("order"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(slots)), start, step, lambda state: state["order"])


class Phase:
    """Slots in which the same streams have blocks: its first slot, the blocks gone before it, and its schedule."""

    def __init__(self, number: int, start: int, base: list[int], parts: list[int], left: list[int]):
        self.number, self.start, self.base = number, start, base
        common = math.gcd(*parts)
        self.parts = [p // common for p in parts]
        self.size = sum(self.parts)
        self.slots = min(self.size, sum(left))  # a period, or more than the phase has
        self.left = left

    def work_out(self, spark: SparkSession, folder: str) -> tuple[int, list[int]]:
        """Write the schedule; returns the slots of the phase and the blocks that they take of each stream."""
        active = [i for i, p in enumerate(self.parts) if p]
        last = [(self.left[i] - 1) % self.parts[i] for i in active]  # nth of a stream's last block, in its period
        wanted = F.array(*[F.struct(F.lit(i).alias("stream"), F.lit(n).cast("long").alias("nth"))
                           for i, n in zip(active, last)])
        done, found = [0] * len(self.parts), {}
        for start in range(0, self.slots, WINDOW):
            slots = min(WINDOW, self.slots - start)
            lag = [p * start - n * self.size for p, n in zip(self.parts, done)]
            order = slot_window(_numbers(self.parts), F.lit(self.size).cast("long"), _numbers(lag), _numbers(done), slots)
            path = f"{folder}/phase={self.number}/window={start}"
            (spark.range(1).select(F.posexplode(order).alias("slot", "at"))
             .select("at.stream", "at.nth", (F.col("slot") + start).cast("long").alias("slot"), "at.before")
             .write.parquet(path))
            # the last slot, and a slot for each stream
            at = F.struct(F.col("stream").alias("stream"), F.col("nth").alias("nth"))
            for r in (spark.read.parquet(path)
                      .filter((F.col("slot") == start + slots - 1) | F.array_contains(wanted, at)).collect()):
                found[r["stream"], r["nth"]] = r["slot"], r["before"]
                if r["slot"] == start + slots - 1:
                    done = [n + (i == r["stream"]) for i, n in enumerate(r["before"])]
        ends = {}  # of the streams: the slot of the last block, if the schedule has it
        for i, n in zip(active, last):
            periods = (self.left[i] - 1) // self.parts[i]
            if (i, n) in found and (periods == 0 or self.slots == self.size):
                ends[periods * self.size + found[i, n][0]] = i, periods, found[i, n][1]
        end = min(ends)
        ended, periods, before = ends[end]
        return end + 1, [periods * p + n + (i == ended) for i, (p, n) in enumerate(zip(self.parts, before))]


def phases(spark: SparkSession, parts: list[int], blocks: list[int], folder: str) -> list[Phase]:
    """The phases of streams with so many ``blocks``; their schedules are written below ``folder``."""
    out, start, base = [], 0, [0] * len(parts)
    while any(n < b for n, b in zip(base, blocks)):
        left = [b - n for n, b in zip(base, blocks)]
        phase = Phase(len(out), start, base, [p if n else 0 for p, n in zip(parts, left)], left)
        slots, taken = phase.work_out(spark, folder)
        out.append(phase)
        start, base = start + slots, [n + t for n, t in zip(base, taken)]
    return out


def mixed(docs: DataFrame, weights: dict[str, float], rest: float = 0.05, block: int = BLOCK,
          seed: int = SEED) -> DataFrame:
    """``docs`` with ``mix_slot`` (of its block) and ``mix_position`` (0, 1, ... over all documents)."""
    spark = docs.sparkSession
    parts = exact_parts(weights, rest)
    columns = [c for c in docs.columns if c not in ("mix_slot", "mix_position")]
    inner = {c: f"__in_{i}" for i, c in enumerate(columns)}  # so that no column clashes with those below
    doc_id, source = F.col(inner["doc_id"]), F.col(inner["source"])
    stream = F.coalesce(*[F.when(source == s, F.lit(i)) for i, s in enumerate(weights)], F.lit(len(weights)))
    plain = [inner[f.name] for f in docs.select(*columns).schema if f.dataType.typeName() in
             ("string", "long", "integer", "double", "float", "boolean", "date", "timestamp")]
    # rows without an id are spread by their other columns, which also order those that repeat one
    whole = F.xxhash64(*plain)
    order = F.xxhash64(F.lit(seed), F.when(doc_id.isNull(), whole).otherwise(doc_id))
    rows = (docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
            .withColumn("__stream", stream).withColumn("__order", order)
            .withColumn("__bucket", F.pmod("__order", F.lit(BUCKETS))))

    key = ["__stream", "__bucket"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__stream").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*key, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    # one row a source
    counted = {r["__stream"]: r["n"] for r in sizes.groupBy("__stream").agg(F.sum("__n").alias("n")).collect()}
    totals = [counted.get(i, 0) for i in range(len(parts))]
    folder = scratch_path(spark, "mix-schedule")
    found = phases(spark, parts, [-(-n // block) for n in totals], folder)
    if not found:
        return docs.select(*columns, F.lit(0).cast("long").alias("mix_slot"), F.lit(0).cast("long").alias("mix_position"))

    # of each phase: its first slot, period, and by stream the parts and the blocks before it
    table = spark.createDataFrame([(p.number, p.start, p.size, p.parts, p.base) for p in found],
                                  "__phase int, __start long, __size long, __parts array<long>, __base array<long>")
    schedule = spark.read.parquet(folder).select(
        F.col("phase").cast("int").alias("__phase"), F.col("stream").alias("__stream"),
        F.col("nth").alias("__nth"), F.col("slot").alias("__slot"), F.col("before").alias("__before"))
    if sum(p.slots for p in found) * len(parts) <= BROADCAST_CELLS:
        schedule = F.broadcast(schedule)

    in_bucket = Window.partitionBy(*key).orderBy("__order", inner["doc_id"], whole)
    started = F.filter(F.array(*[F.struct(F.lit(p.number).alias("phase"), F.array(*[F.lit(n).cast("long") for n in p.base])
                                          .alias("base")) for p in found]),
                       lambda p: F.get(p["base"], F.col("__stream")) <= F.col("__k"))
    ranked = (rows.withColumn("__rank", F.row_number().over(in_bucket))
              .join(F.broadcast(offsets), key)
              .withColumn("__seq", F.col("__offset") + F.col("__rank") - 1)
              .withColumn("__k", F.expr(f"__seq div {block}"))
              .withColumn("__phase", F.element_at(started, -1)["phase"])
              .join(F.broadcast(table), "__phase")
              .withColumn("__in_phase", F.col("__k") - F.get("__base", F.col("__stream")))
              .withColumn("__part", F.get("__parts", F.col("__stream")))
              .withColumn("__period", F.expr("__in_phase div __part"))
              .withColumn("__nth", F.pmod("__in_phase", "__part")))
    slotted = (ranked.join(schedule, ["__phase", "__stream", "__nth"])
               .withColumn("mix_slot", F.col("__start") + F.col("__period") * F.col("__size") + F.col("__slot")))
    # documents that go out in earlier slots: those blocks, as far as the stream has documents
    gone = [F.least((F.get("__base", F.lit(i)) + F.col("__period") * F.get("__parts", F.lit(i))
                     + F.get("__before", F.lit(i))) * block, F.lit(n).cast("long")) for i, n in enumerate(totals)]
    return (slotted.withColumn("mix_position", sum(gone[1:], gone[0]) + F.col("__seq") - F.col("__k") * block)
            .select(*[F.col(n).alias(c) for c, n in inner.items()], "mix_slot", "mix_position"))


def in_mixed_order(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mix, also over the files they are written to."""
    kept = {c: f"__kept_{c}" for c in docs.columns if c in ("mix_slot", "mix_position")}
    rows = mixed(docs.withColumnsRenamed(kept), weights, **options)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(tasks, "mix_position").sortWithinPartitions("mix_position")
            .drop("mix_slot", "mix_position")
            .withColumnsRenamed({n: c for c, n in kept.items()}).select(*docs.columns))


def in_written_order(docs: DataFrame) -> DataFrame:
    """Rows read from the files of :func:`in_mixed_order`: in that order again, with their ``mix_position``.

    Spark deals files to tasks by size, so rows that are read come in no order. A
    row's place is that of its file, by the number of the task that wrote it
    and of the file in that task, and then its number in the file.
    """
    columns = [c for c in docs.columns if c != "mix_position"]
    inner = {c: f"__in_{i}" for i, c in enumerate(columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()],
                       F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    # one row a file
    sizes = rows.groupBy("__file").agg((F.max("__row") + 1).alias("__n"))
    task, part = (F.regexp_extract("__file", r, 1).cast("long") for r in (r"/part-(\d+)-[^/]*$", r"-c(\d+)\.[^/]*$"))
    earlier = Window.orderBy(task, part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.join(F.broadcast(offsets), "__file")
            .select(*[F.col(n).alias(c) for c, n in inner.items()],
                    (F.col("__offset") + F.col("__row")).alias("mix_position"))
            .repartitionByRange(tasks, "mix_position").sortWithinPartitions("mix_position"))
