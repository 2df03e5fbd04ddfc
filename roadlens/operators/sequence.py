"""Position of each pass in its car's time-ordered sequence, skew-safe.

A plain ``row_number()`` over ``Window.partitionBy(car)`` sends every pass of
a car to one task; one plate (a placeholder plate, a fleet vehicle) may hold
a large share of all rows. Here the sequence number is built from two small
offset tables instead:

* passes per (car, second) and their running offset inside (car, hour);
* passes per (car, hour) and their running offset inside the car;
* ``seq = hour offset + second offset + row_number()`` over the passes that
  share one (car, second).

The largest window holds at most one car's hours (its partition is the
count table, one row per hour) or the seconds of one hour (3,600 rows), and
the per-pass window only sees passes with the same car and second. The pass
that is first in its second carries that second's count, so both offset
tables come from the shuffle of the per-pass window and the input is read
once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from roadlens.functions.dates import lenient_seconds
from roadlens.schema import TIEBREAK_COLUMN

# Passes whose time does not parse sort first, before every valid time.
_NO_TIME = -(2 ** 62)

def sequence_number(df: DataFrame, key: str = "car", time_col: str = "action_time",
                    tiebreak: list[str] | None = None, out: str = "seq") -> DataFrame:
    """Add ``out`` = 1..n, the rank of each row inside ``key`` by time.

    Time is the lenient value of ``time_col`` (hour 25 rolls into the next
    day), then the raw text, then ``tiebreak`` columns (default: monitor,
    camera and the unique ``event_id`` when present). The order must be total
    for a repeatable result. Rows with a null key are numbered as one key.
    """
    if tiebreak is None:
        tiebreak = ["monitor_id", "camera_id"]
        if TIEBREAK_COLUMN in df.columns:
            tiebreak.append(TIEBREAK_COLUMN)
    t = F.coalesce(lenient_seconds(time_col), F.lit(_NO_TIME).cast(T.LongType()))
    hour = F.coalesce(F.floor(F.col("_t") / 3600), F.lit(0).cast(T.LongType()))
    # null-free keys: joins keep the partitioning of the windows, and both uses
    # of the numbered rows share one shuffle (the order names every column, so
    # that neither use drops one)
    same = ["_k", "_z"]
    rest = [c for c in df.columns if c not in (key, time_col, *tiebreak)]
    second = Window.partitionBy(*same, "_t")
    numbered = (df.withColumn("_t", t)
                .withColumn("_k", F.coalesce(F.col(key).cast("string"), F.lit("")))
                .withColumn("_z", F.col(key).isNull())
                .withColumn("_rn", F.row_number().over(second.orderBy(time_col, *tiebreak, *rest, key)))
                .withColumn("_n", F.count(F.lit(1)).over(second)))

    before = Window.unboundedPreceding
    per_second = (numbered.filter(F.col("_rn") == 1).select(*same, hour.alias("_h"), "_t", "_n")
                  .withColumn("_off_s", F.coalesce(F.sum("_n").over(
                      Window.partitionBy(*same, "_h").orderBy("_t").rowsBetween(before, -1)), F.lit(0))))
    per_hour = (per_second.groupBy(*same, "_h").agg(F.sum("_n").alias("_nh"))
                .withColumn("_off_h", F.coalesce(F.sum("_nh").over(
                    Window.partitionBy(*same).orderBy("_h").rowsBetween(before, -1)), F.lit(0))))
    offsets = (per_second.join(per_hour, [*same, "_h"])
               .select(*same, "_t", (F.col("_off_h") + F.col("_off_s")).alias("_off")))
    return (numbered.join(offsets, [*same, "_t"])
            .withColumn(out, (F.col("_off") + F.col("_rn")).cast(T.LongType()))
            .select(*[c for c in df.columns if c != out], out))
