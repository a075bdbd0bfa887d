"""Motion planning over consecutive snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import haversine_km, lerp, lerp_heading
from skyfold.operators.latest import latest_by_last_seen
from skyfold.operators.metrics import median_batch_gap, motion_usable

# Fixed values -------------------------------------------------------------
MAX_GAP_SECONDS = 180
MAX_DISTANCE_KM = 200.0
MIN_DURATION_MS = 1_000
MAX_DURATION_MS = 20_000
REFRESH_INTERVAL_MS = 10_000
# --------------------------------------------------------------------------

POSE = ["lat", "lon", "heading", "speed", "altitude", "last_seen"]


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c))


def can_interpolate(s: str = "start_", t: str = "", max_gap: int = MAX_GAP_SECONDS,
                    max_km: float = MAX_DISTANCE_KM) -> Column:
    """Finite coordinates, time not backwards, gap ≤ 180 s, ≤ 200 km."""
    coords = _finite(s + "lat") & _finite(s + "lon") & _finite(t + "lat") & _finite(t + "lon")
    both_t = F.col(s + "last_seen").isNotNull() & F.col(t + "last_seen").isNotNull()
    dt = F.col(t + "last_seen") - F.col(s + "last_seen")
    time_ok = ~both_t | ((dt >= 0) & (F.abs(dt) <= max_gap))
    dist = haversine_km(s + "lat", s + "lon", t + "lat", t + "lon")
    return F.coalesce(coords & time_ok & (dist <= max_km), F.lit(False))


def motion_start(items: DataFrame) -> DataFrame:
    """Start pose from prev_* when usable, else the current pose."""
    from skyfold.operators.metrics import motion_usable
    use = motion_usable()
    cols = [F.when(use, F.coalesce(F.col("prev_" + c), F.col(c))).otherwise(F.col(c)).alias("start_" + c)
            for c in POSE]
    return items.select("*", *cols, use.alias("uses_previous"))


def interpolate_positions(pairs: DataFrame, steps: int = 4, max_gap: int = MAX_GAP_SECONDS,
                          max_km: float = MAX_DISTANCE_KM) -> DataFrame:
    """Expand each pair into ``steps + 1`` frames at progress i/steps;
    lat, lon, speed, altitude linear, heading on the shortest arc; a pair
    that cannot be interpolated shows the target in every frame."""
    steps = max(1, int(steps))
    d = pairs.select("*", can_interpolate(max_gap=max_gap, max_km=max_km).alias("interpolable"),
                     F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("frame"))
    p = (F.col("frame") / F.lit(float(steps)))
    ok = F.col("interpolable")
    pick = lambda expr, c: F.when(ok, expr).otherwise(F.col(c))
    ids = [c for c in ("icao24", "event_id") if c in pairs.columns]
    return d.select(
        *ids, "frame", p.alias("progress"), "interpolable",
        pick(lerp("start_lat", "lat", p), "lat").alias("frame_lat"),
        pick(lerp("start_lon", "lon", p), "lon").alias("frame_lon"),
        pick(lerp_heading("start_heading", "heading", p), "heading").alias("frame_heading"),
        pick(lerp("start_speed", "speed", p), "speed").alias("frame_speed"),
        pick(lerp("start_altitude", "altitude", p), "altitude").alias("frame_altitude"))


def batch_durations(batches: DataFrame, batch: str = "batch_epoch") -> DataFrame:
    """Animation duration between consecutive distinct batches:
    (batch − previous)·1000 clamped to [1 s, 20 s]; fallback = refresh
    interval.  The lag over distinct batches runs in day chunks."""
    from skyfold.operators.sequence import previous_values, time_chunk
    b = batches.select(batch).where(F.col(batch).isNotNull()).distinct()
    b = previous_values(b, [], [batch], [batch], prefix="_p_", chunk=time_chunk(batch, 86400)) \
        .withColumnRenamed("_p_" + batch, "previous_batch")
    meas = (F.col(batch) - F.col("previous_batch")) * 1000
    clamp = lambda x: F.least(F.lit(MAX_DURATION_MS), F.greatest(F.lit(MIN_DURATION_MS), x))
    return b.select(batch, "previous_batch",
                    F.when(F.col("previous_batch").isNotNull() & (F.col(batch) > F.col("previous_batch")),
                           clamp(meas)).otherwise(F.lit(clamp(F.lit(REFRESH_INTERVAL_MS))))
                    .cast("long").alias("duration_ms"))


def motion_plan(items: DataFrame, steps: int = 4) -> DataFrame:
    """Q7 frames: dedup items (A2 on map items) -> start pose (W8) -> frames."""
    starts = motion_start(latest_by_last_seen(items, ts="last_seen", tiebreak="callsign"))
    return interpolate_positions(starts, steps)


def motion_answer(items: DataFrame) -> DataFrame:
    """Q7 without its frames: per aircraft the start pose (W8), the shared
    duration (A16, one row, broadcast) and whether it stands still (W5's
    threshold between start and target)."""
    from skyfold.operators.tracks import STATIC_THRESHOLD_KM
    one = latest_by_last_seen(items, ts="last_seen", tiebreak="callsign")
    usable = motion_usable()
    still = usable & (haversine_km("prev_lat", "prev_lon", "lat", "lon") <= STATIC_THRESHOLD_KM)
    return motion_start(one).withColumn("is_static", F.coalesce(still, F.lit(False))).crossJoin(
        F.broadcast(median_batch_gap(one).select("duration_ms")))
