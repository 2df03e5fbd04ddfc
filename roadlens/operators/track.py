"""Per-car tracks and path conversion along a monitor sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.numbers import half_up_ratio
from roadlens.operators.common import legal_cars
from roadlens.operators.paths import many_path_counts
from roadlens.operators.sequence import sequence_number
from roadlens.operators.slices import SLICE_KEY, SLICE_ORDER, SLICE_SECONDS, track_slices
from roadlens.schema import TIEBREAK_COLUMN

# Passes per partial track string when building long tracks in two levels.
TRACK_BLOCK = 1024


def _sequence_columns(flow: DataFrame, extra: list[str]) -> DataFrame:
    cols = ["car", "action_time", "monitor_id", "camera_id"] + extra
    if TIEBREAK_COLUMN in flow.columns:
        cols.append(TIEBREAK_COLUMN)
    return legal_cars(flow).select(*dict.fromkeys(cols))


def car_track_blocks(flow: DataFrame, block: int = TRACK_BLOCK) -> DataFrame:
    """Tracks in blocks of ``block`` consecutive passes of a car.

    ``car``, ``block`` (0, 1, ...), ``first_seq``/``last_seq`` (positions of
    the block's first and last pass in the car's sequence), ``last_date``
    (date of the block's last pass) and ``track_part`` (monitor ids in time
    order, ``,``-joined, null monitors skipped). Every row is bounded by
    ``block`` passes whatever the car, so this form also holds for plates
    with more passes than fit in one text value.
    """
    ranked = sequence_number(_sequence_columns(flow, ["date"]))
    return (ranked.withColumn("block", F.floor((F.col("seq") - 1) / block))
            .groupBy("car", "block")
            .agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
                 F.max_by("date", "seq").alias("last_date"),
                 F.expr("listagg(monitor_id, ',') WITHIN GROUP (ORDER BY seq)").alias("track_part")))


def car_track(flow: DataFrame, block: int = SLICE_SECONDS) -> DataFrame:
    """One row per car: ``date`` of its last pass, ``car``, ``car_track``.

    ``car_track`` is the monitor ids of the car's passes in time order joined
    by ``,`` (null monitors are skipped). The text is put together per slice
    of ``block`` seconds of the car's time, so the last step only joins one
    part per slice; the result row itself holds the whole track.
    """
    known = F.filter("runs", lambda r: r["label"].isNotNull())
    ids = F.flatten(F.transform(known, lambda r: F.array_repeat(r["label"], r["n"].cast("int"))))
    parts = track_slices(flow, last_date=True, seconds=block).select(
        *SLICE_KEY, F.element_at("runs", -1)["last"]["date"].alias("last_date"),
        F.when(F.size(known) > 0, F.array_join(ids, ",")).alias("track_part"))
    return (parts.groupBy("car")
            .agg(F.max_by("last_date", F.struct(*SLICE_ORDER)).alias("date"),
                 F.expr(f"listagg(track_part, ',') WITHIN GROUP (ORDER BY {', '.join(SLICE_ORDER)})").alias("car_track"))
            .select("date", "car", "car_track"))


def path_step_counts(flow: DataFrame, path: list[str]) -> DataFrame:
    """For each prefix p1..pi of ``path``: occurrences as a contiguous run.

    Returns ``step`` (i), ``path`` (the prefix text), ``cnt`` (occurrences in
    all cars' tracks, overlapping runs counted separately) and ``prev_cnt``
    (the count of step i-1; null for step 1). Matching is by whole monitor id;
    see :func:`roadlens.operators.paths.many_path_counts`.
    """
    return many_path_counts(flow, {"": path}).drop("path_id")


def path_conversion(flow: DataFrame, path: list[str]) -> DataFrame:
    """Step conversion rates along ``path``.

    One row per step i >= 2 with a non-zero count: ``step``, ``path`` (the
    prefix p1..pi), ``cnt``, ``prev_cnt`` and ``rate = cnt / prev_cnt``
    rounded half-up to two decimals. Counts never grow with i, so the
    previous non-zero step is simply step i-1.
    """
    return conversion_rates(path_step_counts(flow, path))


def conversion_rates(counts: DataFrame) -> DataFrame:
    """Rates of the steps of :func:`path_step_counts`."""
    return (counts.filter((F.col("step") >= 2) & (F.col("cnt") > 0))
            .withColumn("rate", half_up_ratio("cnt", "prev_cnt", 2)))
