"""Monitor-level operators: flow top-N, speed ranking, camera health."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from roadlens.schema import DETAIL_COLUMNS, TIEBREAK_COLUMN, speed_kmh

# Fixed speed bands (km/h): lower edge inclusive, upper edge exclusive.
SPEED_HIGH = 120
SPEED_MEDIUM = 90
SPEED_NORMAL = 60


def monitor_flow(flow: DataFrame) -> DataFrame:
    """Passes per monitor: ``monitor_id``, ``car_count`` (passes without a monitor belong to none)."""
    return flow.filter(F.col("monitor_id").isNotNull()).groupBy("monitor_id").agg(F.count(F.lit(1)).alias("car_count"))


def topn_monitor(flow: DataFrame, n: int) -> DataFrame:
    """The ``n`` monitors with the most passes (ties by monitor id)."""
    return monitor_flow(flow).orderBy(F.desc("car_count"), F.asc("monitor_id")).limit(n)


def topn_monitor_detail(flow: DataFrame, n: int) -> DataFrame:
    """All passes at the top-``n`` monitors (the detail result columns)."""
    top = topn_monitor(flow, n).select("monitor_id")
    # at most n rows
    return flow.join(F.broadcast(top), "monitor_id", "left_semi").select(*DETAIL_COLUMNS)


def speed_bands(flow: DataFrame) -> DataFrame:
    """Passes per monitor in each speed band; null speeds are in no band, null monitors are left out."""
    s = speed_kmh("speed")
    return flow.filter(F.col("monitor_id").isNotNull()).groupBy("monitor_id").agg(
        F.count_if(s >= SPEED_HIGH).alias("high_count"),
        F.count_if((s >= SPEED_MEDIUM) & (s < SPEED_HIGH)).alias("medium_count"),
        F.count_if((s >= SPEED_NORMAL) & (s < SPEED_MEDIUM)).alias("normal_count"),
        F.count_if(s < SPEED_NORMAL).alias("low_count"),
    )


def speed_rank_monitor(flow: DataFrame, n: int) -> DataFrame:
    """The ``n`` fastest monitors: most high-band passes, then medium, normal, low."""
    return speed_bands(flow).orderBy(
        F.desc("high_count"), F.desc("medium_count"), F.desc("normal_count"),
        F.desc("low_count"), F.asc("monitor_id")).limit(n)


def speed_top10_detail(flow: DataFrame, n: int, per_monitor: int = 10) -> DataFrame:
    """The ``per_monitor`` fastest passes at each of the ``n`` fastest monitors.

    Ties by time, car, camera, road, date (and the unique tie-break column
    when present), so the kept rows do not depend on the partitioning.
    The row-number filter is planned as a per-partition group limit before the
    shuffle, so a busy monitor contributes at most ``per_monitor`` rows per task.
    """
    top = speed_rank_monitor(flow, n).select("monitor_id")
    order = [F.desc_nulls_last("_speed"), F.asc("action_time"), F.asc("car"), F.asc("camera_id"),
             F.asc("road_id"), F.asc("date")]
    if TIEBREAK_COLUMN in flow.columns:
        order.append(F.asc(TIEBREAK_COLUMN))
    w = Window.partitionBy("monitor_id").orderBy(*order)
    return (flow.join(F.broadcast(top), "monitor_id", "left_semi")  # at most n rows
            .withColumn("_speed", speed_kmh("speed"))
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= per_monitor)
            .select(*DETAIL_COLUMNS))


def camera_registry(flow: DataFrame) -> DataFrame:
    """Registry of cameras: distinct (``monitor_id``, ``camera_id``) seen in passes."""
    return (flow.filter(F.col("monitor_id").isNotNull() & F.col("camera_id").isNotNull())
            .select("monitor_id", "camera_id").distinct())


def monitor_camera_state(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registered monitor: cameras with and without passes in ``flow``.

    ``monitor_id``, ``normal_camera_count``, ``abnormal_camera_count``,
    ``abnormal_camera_ids`` (sorted, comma separated; null when none).
    Cameras seen but not registered are ignored.
    """
    seen = camera_registry(flow).withColumn("_seen", F.lit(True))
    reg = registry.select("monitor_id", "camera_id").distinct()
    state = reg.join(seen, ["monitor_id", "camera_id"], "left")
    broken = F.col("_seen").isNull()
    return state.groupBy("monitor_id").agg(
        F.count_if(~broken).alias("normal_camera_count"),
        F.count_if(broken).alias("abnormal_camera_count"),
        F.expr("listagg(CASE WHEN _seen IS NULL THEN camera_id END, ',') "
               "WITHIN GROUP (ORDER BY camera_id)").alias("abnormal_camera_ids"),
    )


def monitor_state(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: monitor and camera health of the registry against ``flow``.

    A monitor is abnormal when any of its registered cameras has no pass.
    ``abnormal_monitor_camera_infos`` lists ``monitor:cam,cam`` items joined
    by ``~``, sorted by monitor ('' when all are normal). The text is bounded
    by the registry, not by the passes.
    """
    per = monitor_camera_state(flow, registry)
    bad = F.col("abnormal_camera_count") > 0
    return per.agg(
        F.count_if(~bad).alias("normal_monitor_count"),
        F.coalesce(F.sum("normal_camera_count"), F.lit(0)).alias("normal_camera_count"),
        F.count_if(bad).alias("abnormal_monitor_count"),
        F.coalesce(F.sum("abnormal_camera_count"), F.lit(0)).alias("abnormal_camera_count"),
        F.coalesce(F.expr("listagg(CASE WHEN abnormal_camera_count > 0 THEN "
                          "concat(monitor_id, ':', abnormal_camera_ids) END, '~') "
                          "WITHIN GROUP (ORDER BY monitor_id)"), F.lit("")).alias("abnormal_monitor_camera_infos"),
    )
