"""Per-aircraft state: latest row, previous row, tracks, membership
(A1, A2, A11, W1, W2, W17).  All keyed by icao24."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.expr import norm_icao24
from skyfold.operators.filters import Bbox, classify_bbox
from skyfold.operators.sequence import previous_values, time_chunk

# Fixed values -------------------------------------------------------------
TRACK_WRITE_LENGTH = 180
TRACK_READ_LENGTH = 120
# --------------------------------------------------------------------------

PREV_SOURCE = ["lat", "lon", "heading", "velocity", "_alt", "last_contact"]
PREV_NAMES = ["prev_lat", "prev_lon", "prev_heading", "prev_velocity", "prev_altitude",
              "prev_last_contact"]
EVENT_ORDER = ["last_contact", "batch_epoch", "event_id"]


def latest_per_aircraft(df: DataFrame, key: str = "icao24", tiebreak: str = "event_id") -> DataFrame:
    """A1: one row per aircraft.  A newer batch wins (non-null beats null) even
    over a newer last_contact, then newer last_contact (null loses), then the
    tie-break column.  One partial aggregate: ``max_by`` combines map-side, so
    a hot aircraft never gathers its rows in one task."""
    cols = df.columns
    k = norm_icao24(F.col(key), validate=False)
    order = F.struct(F.col("batch_epoch"), F.col("last_contact"), F.col(tiebreak))
    return (df.withColumn("_k", k).where(F.col("_k").isNotNull())
            .groupBy("_k").agg(F.max_by(F.struct(*cols), order).alias("_r"))
            .select(F.col("_k").alias(key), *[F.col("_r")[c].alias(c) for c in cols if c != key]))


def latest_by_last_seen(df: DataFrame, key: str = "icao24", ts: str = "last_contact",
                        tiebreak: str = "event_id") -> DataFrame:
    """A2: trim and lower-case the id, drop null coordinates / blank id, keep max last_seen (missing ranks
    lowest, later row wins ties -> tie-break column)."""
    cols = df.columns
    valid = df.withColumn(key, norm_icao24(F.col(key), validate=False)).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col(key).isNotNull())
    return (valid.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.struct(F.col(ts), F.col(tiebreak))).alias("_r"))
            .select(*[F.col("_r")[c].alias(c) for c in cols]))


def with_previous(df: DataFrame, key: str = "icao24", order=None,
                  split_seconds: int | None = 86400) -> DataFrame:
    """Attach the aircraft's preceding event (prev_lat, prev_lon,
    prev_heading, prev_velocity, prev_altitude = geo else baro,
    prev_last_contact).  Hot aircraft are split into day chunks."""
    order = order or EVENT_ORDER
    d = df.withColumn("_alt", F.coalesce("geo_altitude", "baro_altitude"))
    chunk = time_chunk("last_contact", split_seconds) if split_seconds else None
    out = previous_values(d, [key], order, PREV_SOURCE, prefix="_p_", chunk=chunk)
    return out.select(*df.columns, *[F.col("_p_" + s).alias(n) for s, n in zip(PREV_SOURCE, PREV_NAMES)])


def build_latest(positions: DataFrame, key: str = "icao24") -> DataFrame:
    """M5 latest table: the last processed event per aircraft plus its
    predecessor's fields (the batch form of the write-time previous snapshot).

    ``row_number() <= 2`` becomes a WindowGroupLimit that keeps two rows per
    key *before* the shuffle, so the exchange carries at most two rows per
    aircraft per input partition whatever the skew."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in EVENT_ORDER])
    top2 = (positions.where(F.col(key).isNotNull())
            .withColumn("_alt", F.coalesce("geo_altitude", "baro_altitude"))
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2))
    prev = [F.lead(s).over(w).alias(n) for s, n in zip(PREV_SOURCE, PREV_NAMES)]
    return (top2.select("*", *prev).where(F.col("_rn") == 1)
            .select(*positions.columns, *PREV_NAMES))


def recent_track(positions: DataFrame, n: int = TRACK_READ_LENGTH, key: str = "icao24",
                 as_array: bool = False) -> DataFrame:
    """Newest ``n`` points per aircraft, newest first (WindowGroupLimit)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in EVENT_ORDER])
    ranked = positions.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if not as_array:
        return ranked
    pt = F.struct(F.col("rank"), F.col("lat"), F.col("lon"), F.col("heading"), F.col("velocity"),
                  F.coalesce("geo_altitude", "baro_altitude").alias("altitude"),
                  F.col("last_contact"), F.col("on_ground"))
    return (ranked.groupBy(key).agg(F.sort_array(F.collect_list(pt)).alias("track"))
            .select(key, F.transform("track", lambda x: x.dropFields("rank")).alias("track")))


def latest_batch_epoch(df: DataFrame, batch: str = "batch_epoch") -> DataFrame:
    """The largest non-null batch id (one row)."""
    return df.agg(F.max(batch).alias("latest_batch_epoch"))


def membership_changes(positions: DataFrame, bbox: Bbox, key: str = "icao24",
                       split_seconds: int | None = 86400) -> DataFrame:
    """Geofence enter/leave events.  UNKNOWN (null coordinate) leaves the
    state as it is, so those rows drop before comparing with the previous one."""
    known = (positions.select(key, *EVENT_ORDER, classify_bbox(bbox).alias("_cls"))
             .where(F.col("_cls") != "UNKNOWN")
             .withColumn("inside", F.col("_cls") == "INSIDE").drop("_cls"))
    chunk = time_chunk("last_contact", split_seconds) if split_seconds else None
    with_prev = previous_values(known, [key], EVENT_ORDER, ["inside"], prefix="was_", chunk=chunk)
    changes = with_prev.where(F.col("was_inside").isNull() & F.col("inside")
                              | (F.col("was_inside") != F.col("inside")))
    return changes.select(key, *EVENT_ORDER,
                          F.when(F.col("inside"), "enter").otherwise("leave").alias("change"))


def current_members(positions: DataFrame, bbox: Bbox, key: str = "icao24") -> DataFrame:
    """Aircraft whose last known classification is INSIDE."""
    known = (positions.select(key, *EVENT_ORDER, classify_bbox(bbox).alias("_cls"))
             .where(F.col("_cls") != "UNKNOWN"))
    last = known.groupBy(key).agg(
        F.max_by(F.col("_cls"), F.struct(*[F.col(c) for c in EVENT_ORDER])).alias("_cls"))
    return last.where(F.col("_cls") == "INSIDE").select(key)
