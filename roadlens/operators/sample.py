"""Proportional hourly sampling of cars, with their passes and tracks.

Quota rule (per day): ``per_day = extract_num div number_of_days``; an hour
gets ``floor(hour_cars / day_cars * per_day)`` cars (doubles, in that
order), at most ``hour_cars``. The truncation loss is not redistributed.

Selection: inside each hour the cars with the smallest
``md5(car|date_hour|seed)`` (ties by car) are taken, so the sample is
repeatable, independent per hour, and the same for any partitioning.

The pick never ranks a whole hour in one task. Cars are ranked inside
(hour, bucket) groups, the bucket being the hash's first two hex digits
(256 per hour); the same window stage counts each bucket, and that small
histogram locates the one bucket where the quota is crossed. Buckets before
it are taken whole, and that bucket up to the remaining quota.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from roadlens.functions.dates import date_and_hour, lenient_seconds
from roadlens.functions.numbers import int_div
from roadlens.operators.common import legal_cars
from roadlens.operators.track import car_track

# Hex digits of the hash used as the histogram bucket.
BUCKET_DIGITS = 2


def hour_cars(flow: DataFrame) -> DataFrame:
    """Distinct (``date``, ``date_hour``, ``car``) of the passes.

    ``date`` and ``date_hour`` come from the text of ``action_time`` (an hour
    label may be 24 or more). Passes whose time does not parse belong to no
    hour and no day.
    """
    day, hour = date_and_hour("action_time")  # of a time that parses; one split gives both
    return (legal_cars(flow).filter(lenient_seconds("action_time").isNotNull())
            .select(day.alias("date"), F.concat_ws("_", day, hour).alias("date_hour"), "car").distinct())


def hourly_car_count(flow: DataFrame) -> DataFrame:
    """Distinct cars per hour: ``date``, ``date_hour``, ``cars``."""
    return hour_cars(flow).groupBy("date", "date_hour").agg(F.count(F.lit(1)).alias("cars"))


def _quota(cars: str, day_cars: str, n_days, extract_num: int):
    """``least(cars, floor(cars / day_cars * (extract_num div n_days)))`` in doubles."""
    per_day = F.when(n_days > 0, int_div(F.lit(extract_num).cast(T.LongType()), n_days.cast(T.LongType())))
    share = F.col(cars).cast(T.DoubleType()) / F.col(day_cars).cast(T.DoubleType()) * per_day.cast(T.DoubleType())
    return F.least(F.col(cars), F.floor(share).cast(T.LongType()))


def _day_count(rows: DataFrame):
    # over one row per hour or bucket, from the shuffle that the main plan reads too
    return rows.select(F.count_distinct("date")).scalar()


def hourly_quota(flow: DataFrame, extract_num: int) -> DataFrame:
    """``date``, ``date_hour``, ``cars``, ``quota`` (cars to draw in that hour)."""
    cars = hour_cars(flow)
    counts = cars.groupBy("date", "date_hour").agg(F.count(F.lit(1)).alias("cars"))
    # one row per hour label: the per-day window is small
    return (counts.withColumn("_day_cars", F.sum("cars").over(Window.partitionBy("date")))
            .withColumn("quota", _quota("cars", "_day_cars", _day_count(counts.filter(F.col("cars") > 0)), extract_num))
            .drop("_day_cars"))


def _hash(seed: int):
    return F.md5(F.concat_ws("|", F.col("car"), F.col("date_hour"), F.lit(str(seed))))


def sample_cars(flow: DataFrame, extract_num: int, seed: int = 42) -> DataFrame:
    """The sampled cars: ``date``, ``date_hour``, ``car`` (one row per pick)."""
    cars = hour_cars(flow)
    bucket = ["date", "date_hour", "_b"]
    # rank inside (hour, bucket): about 1/256 of an hour per group; the same
    # shuffle also feeds the histogram below
    in_bucket = Window.partitionBy(*bucket)
    ranked = (cars.withColumn("_h", _hash(seed)).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
              .withColumn("_rn", F.row_number().over(in_bucket.orderBy("_h", "car")))
              .withColumn("_n", F.count(F.lit(1)).over(in_bucket)))
    # one row per bucket, taken from the same window stage (no second shuffle)
    hist = ranked.filter(F.col("_rn") == 1).select(*bucket, "_n")
    # One shuffle by date serves the three histogram windows; a day holds at
    # most 24 (+ overflow) hours x 256 buckets.
    hour = Window.partitionBy("date", "date_hour")
    running = (hist.withColumn("_day_cars", F.sum("_n").over(Window.partitionBy("date")))
               .withColumn("_cars", F.sum("_n").over(hour))
               .withColumn("_before", F.coalesce(F.sum("_n").over(
                   hour.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("quota", _quota("_cars", "_day_cars", _day_count(hist), extract_num)))
    # the bucket where the running count passes the quota: one row per hour
    cut = (running.filter((F.col("_before") <= F.col("quota")) & (F.col("_before") + F.col("_n") > F.col("quota")))
           .select("date_hour", F.col("_b").alias("_cut"), (F.col("quota") - F.col("_before")).alias("_need")))
    # hours without a cut row keep all their cars; the filter keeps the join an
    # outer join, so both uses of the ranked rows share one shuffle
    keep = (F.col("_cut").isNull() | (F.col("_b") < F.col("_cut"))
            | ((F.col("_b") == F.col("_cut")) & (F.col("_rn") <= F.col("_need"))))
    return (ranked.drop("_n").join(cut, "date_hour", "left").filter(keep)
            .select("date", "date_hour", "car"))


def sample_detail(flow: DataFrame, sampled: DataFrame) -> DataFrame:
    """All passes (whole date range) of the sampled cars.

    A semi join on the cars; Spark broadcasts them when their measured size
    allows it and shuffles otherwise.
    """
    return legal_cars(flow).join(sampled.select("car").distinct(), "car", "left_semi")


def sample_track(flow: DataFrame, sampled: DataFrame) -> DataFrame:
    """Tracks of the sampled cars (``date``, ``car``, ``car_track``)."""
    return car_track(sample_detail(flow, sampled))
