"""Track segmentation (W3–W5) and the track report (Q6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.expr import haversine_km
from skyfold.operators.sequence import previous_values, running_sum, time_chunk

# Fixed values -------------------------------------------------------------
SEGMENT_GAP_SECONDS = 15 * 60
CURRENT_FALLBACK_WINDOW_SECONDS = 6 * 60 * 60
STATIC_THRESHOLD_KM = 0.05
# --------------------------------------------------------------------------

POINT_ORDER = ["last_seen", "event_id"]


def track_points(positions: DataFrame) -> DataFrame:
    """Valid track points: coordinates and time present."""
    return positions.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                           & F.col("last_contact").isNotNull()).select(
        "icao24", "event_id", "lat", "lon", F.col("last_contact").alias("last_seen"), "on_ground")


def track_segments(points: DataFrame, gap_seconds: int = SEGMENT_GAP_SECONDS,
                   keys=("icao24",), split_seconds: int | None = None) -> DataFrame:
    """In time order a gap > ``gap_seconds`` starts a new segment;
    segments with fewer than two points are dropped.  Adds ``segment``
    (1-based within the key) and ``segment_points``.

    With ``split_seconds`` the key's sequence is split into time chunks
    (hot keys), stitched by the sequence helpers; segment sizes come from a
    partial aggregate joined back, never from a window over one segment."""
    keys = list(keys)
    chunk = time_chunk("last_seen", split_seconds) if split_seconds else None
    d = previous_values(points, keys, POINT_ORDER, ["last_seen"], prefix="_p_", chunk=chunk)
    brk = F.when(F.col("_p_last_seen").isNull()
                 | (F.abs(F.col("last_seen") - F.col("_p_last_seen")) > gap_seconds), 1).otherwise(0)
    d = d.withColumn("_brk", brk).drop("_p_last_seen")
    d = running_sum(d, keys, POINT_ORDER, F.col("_brk"), "segment", chunk=chunk).drop("_brk")
    sizes = d.groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("segment_points"))
    return d.join(sizes, [*keys, "segment"]).where(F.col("segment_points") >= 2)


def split_current_historical(points: DataFrame, fallback_seconds: int = CURRENT_FALLBACK_WINDOW_SECONDS,
                             key: str = "icao24") -> DataFrame:
    """``side`` = current for points at or after the last takeoff
    (latest on_ground TRUE -> FALSE; a null breaks it), else at or after
    latest − fallback; historical before.  Keys with < 2 points drop."""
    w = Window.partitionBy(key).orderBy(*POINT_ORDER)
    d = points.withColumn("_pog", F.lag("on_ground").over(w))
    takeoff = F.when(F.col("_pog").eqNullSafe(True) & F.col("on_ground").eqNullSafe(False), F.col("last_seen"))
    wk = Window.partitionBy(key)
    d = d.select("*", F.max(takeoff).over(wk).alias("_takeoff"), F.max("last_seen").over(wk).alias("_latest"),
                 F.count(F.lit(1)).over(wk).alias("_n"))
    since = F.coalesce(F.col("_takeoff"), F.col("_latest") - F.lit(fallback_seconds))
    return (d.where(F.col("_n") >= 2)
            .withColumn("side", F.when(F.col("last_seen") >= since, "current").otherwise("historical"))
            .drop("_pog", "_takeoff", "_latest", "_n"))


def track_report(positions: DataFrame, track_points_n: int = 120, gap_seconds: int = SEGMENT_GAP_SECONDS,
                 fallback_seconds: int = CURRENT_FALLBACK_WINDOW_SECONDS) -> DataFrame:
    """Q6: newest ``track_points_n`` points per aircraft (W2) -> W4 -> W3 on
    each side, for all aircraft at once.  W2 bounds every key to a fixed
    number of points before the shuffle, so the later windows are bounded."""
    from skyfold.operators.latest import recent_track
    recent = recent_track(positions, n=track_points_n).drop("rank")
    sided = split_current_historical(track_points(recent), fallback_seconds)
    return track_segments(sided, gap_seconds, keys=("icao24", "side"))


def static_aircraft(positions: DataFrame, threshold_km: float = STATIC_THRESHOLD_KM) -> DataFrame:
    """Per aircraft and batch, moved ≤ threshold since the previous
    distinct batch (the aircraft must be present in both batches)."""
    snap = (positions.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                            & F.col("batch_epoch").isNotNull())
            .groupBy("icao24", "batch_epoch")
            .agg(F.max_by(F.struct("lat", "lon"), F.struct("last_contact", "event_id")).alias("p"))
            .select("icao24", "batch_epoch", "p.lat", "p.lon"))
    # Previous distinct batch overall and previous batch of the aircraft, both
    # as chunked lags (day chunks), so neither a long history nor a hot
    # aircraft lands in a single task.
    day = time_chunk("batch_epoch", 86400)
    batches = previous_values(snap.select("batch_epoch").distinct(), [], ["batch_epoch"], ["batch_epoch"],
                              prefix="global_prev_", chunk=day) \
        .withColumnRenamed("global_prev_batch_epoch", "global_prev")
    d = previous_values(snap, ["icao24"], ["batch_epoch"], ["batch_epoch", "lat", "lon"], prefix="_p_", chunk=day)
    d = d.select("icao24", "batch_epoch", "lat", "lon", F.col("_p_batch_epoch").alias("own_prev"),
                 F.col("_p_lat").alias("plat"), F.col("_p_lon").alias("plon"))
    d = d.join(batches, "batch_epoch")
    moved = haversine_km("plat", "plon", "lat", "lon")
    adjacent = F.col("own_prev").isNotNull() & (F.col("own_prev") == F.col("global_prev"))
    return d.select("icao24", "batch_epoch", F.when(adjacent, moved).alias("moved_km"),
                    F.coalesce(adjacent & (moved <= threshold_km), F.lit(False)).alias("is_static"))
