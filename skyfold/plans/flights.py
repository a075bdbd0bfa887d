"""Composite read queries: map list (Q1), aircraft detail (Q2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import category_or_fallback, norm_icao24, trim_to_null
from skyfold.functions.taxonomy import aircraft_size, fleet_type, normalized_columns
from skyfold.operators.enrich import enrich
from skyfold.operators.filters import (Bbox, airframe_filter, attr_filter, continuity_window,
                                       in_bbox, military_filter, since_filter)
from skyfold.operators.latest import latest_per_aircraft, recent_track

# Fixed values -------------------------------------------------------------
DEFAULT_LIMIT = 200
MAX_LIMIT = 1000
DEFAULT_SORT = "lastSeen"
DEFAULT_ORDER = "desc"
SORT_COLUMNS = {"lastSeen": "last_contact", "speed": "velocity", "altitude": "altitude"}
# --------------------------------------------------------------------------

MAP_ITEM_COLUMNS = [
    "icao24", "callsign", "lat", "lon", "heading", "last_seen", "speed", "altitude",
    "military_hint", "airframe_type", "fleet_type", "aircraft_size", "prev_lat", "prev_lon",
    "prev_heading", "prev_speed", "prev_altitude", "prev_last_seen",
]


def clamp_limit(limit: int | None) -> int:
    if limit is None:
        return DEFAULT_LIMIT
    if int(limit) <= 0:
        raise ValueError("limit must be positive")
    return min(int(limit), MAX_LIMIT)


def snapshots(latest: DataFrame, aircraft: DataFrame, bbox: Bbox, since: int | None,
              with_owner: bool) -> DataFrame:
    """Snapshot path shared by Q1 and Q3: F1 + F3 -> F8 -> A1 -> J1."""
    cand = latest.where(F.col("icao24").isNotNull() & in_bbox(bbox))
    cand = since_filter(cand, since)
    cand = continuity_window(cand)
    dedup = latest_per_aircraft(cand)
    return enrich(dedup, aircraft, with_owner=with_owner)


def to_map_item(snap: DataFrame) -> DataFrame:
    """M12 map item from an enriched snapshot."""
    return normalized_columns(snap).select(
        F.col("icao24"), trim_to_null("callsign").alias("callsign"), "lat", "lon", "heading",
        F.col("last_contact").alias("last_seen"), F.col("velocity").alias("speed"),
        F.coalesce("geo_altitude", "baro_altitude").alias("altitude"),
        "military_hint", F.coalesce("airframe_type", F.lit("unknown")).alias("airframe_type"),
        fleet_type("military_hint", "_cs", "_cat", "_own", normalized=True).alias("fleet_type"),
        aircraft_size("_cat", "_tc", normalized=True).alias("aircraft_size"),
        "prev_lat", "prev_lon", "prev_heading", F.col("prev_velocity").alias("prev_speed"),
        "prev_altitude", F.col("prev_last_contact").alias("prev_last_seen"))


def filtered_snapshots(latest, aircraft, bbox=None, since=None, military=None, airframe=None,
                       category=None, country=None, typecode=None) -> DataFrame:
    bbox = bbox or Bbox.default()
    s = snapshots(latest, aircraft, bbox, since, with_owner=False)
    s = military_filter(s, military)
    s = airframe_filter(s, airframe)
    s = attr_filter(s, "category", category, "lower")
    s = attr_filter(s, "country", country, "lower")
    s = attr_filter(s, "typecode", typecode, "upper")
    return s


def list_flights(latest: DataFrame, aircraft: DataFrame, bbox: Bbox | None = None,
                 since: int | None = None, limit: int | None = None, sort: str = DEFAULT_SORT,
                 order: str = DEFAULT_ORDER, military: str | None = None, airframe: str | None = None,
                 category: str | None = None, country: str | None = None,
                 typecode: str | None = None) -> DataFrame:
    """Q1 items: sorted, limited map items (TakeOrderedAndProject).

    Null sort values rank as -inf; icao24 breaks ties so the answer is total."""
    if sort not in SORT_COLUMNS:
        raise ValueError(f"unsupported sort {sort!r}")
    if order not in ("asc", "desc"):
        raise ValueError(f"unsupported order {order!r}")
    items = to_map_item(filtered_snapshots(latest, aircraft, bbox, since, military, airframe,
                                           category, country, typecode))
    key = {"lastSeen": "last_seen", "speed": "speed", "altitude": "altitude"}[sort]
    ordering = ([F.col(key).desc_nulls_last(), F.col("icao24").desc()] if order == "desc"
                else [F.col(key).asc_nulls_first(), F.col("icao24").asc()])
    return items.orderBy(*ordering).limit(clamp_limit(limit))


def list_summary(latest: DataFrame, aircraft: DataFrame, bbox: Bbox | None = None,
                 since: int | None = None, limit: int | None = None, **filters) -> DataFrame:
    """Q1 summary (O2 + A11): returned count, total matched, limit, latest batch."""
    s = filtered_snapshots(latest, aircraft, bbox, since, **filters)
    lim = clamp_limit(limit)
    return s.agg(F.count(F.lit(1)).alias("total_matched"),
                 F.max("batch_epoch").alias("latest_batch_epoch")).select(
        F.least(F.col("total_matched"), F.lit(lim).cast("long")).alias("count"),
        "total_matched", F.lit(lim).alias("limit"), "latest_batch_epoch")


def flight_detail(latest: DataFrame, aircraft: DataFrame, positions: DataFrame, icao24: str | None,
                  include_track: bool = True, photos: DataFrame | None = None,
                  track_points: int = 120) -> DataFrame:
    """Q2 (single id): one row with nested track array; unknown id -> empty.

    The id is a constant of the plan, so it reaches the scans of both tables; over
    ``sinks.write_tracks`` the track reads the row groups of that aircraft only."""
    one = F.col("icao24") == norm_icao24(F.lit(icao24).cast("string"))
    return flight_details(latest.where(one), aircraft, positions.where(one), None, include_track, photos, track_points)


def flight_details(latest: DataFrame, aircraft: DataFrame, positions: DataFrame, ids: DataFrame | None,
                   include_track: bool = True, photos: DataFrame | None = None,
                   track_points: int = 120, flat: bool = False) -> DataFrame:
    """Q2 for a table of ids: latest row + J1 (all reference columns) + photo
    (J7 result) + newest ``track_points`` track points.  ``flat`` returns the
    scalar part only (no nested columns) for oracle comparison.  Without ``ids``
    the answer is that of all rows given."""
    row = latest if ids is None else latest.join(ids, "icao24", "left_semi")
    name_ok = trim_to_null("manufacturer_name").isNotNull()
    a = aircraft.select(
        norm_icao24("icao24", validate=False).alias("icao24"), "registration",
        F.when(name_ok, F.col("manufacturer_name")).otherwise(F.col("manufacturer_icao")).alias("manufacturer"),
        "model", F.upper(trim_to_null("typecode")).alias("typecode"), "year_built", "owner_operator",
        "country", category_or_fallback("category_description", "icao_aircraft_class", fallback=None)
        .alias("category"), F.col("military_hint").cast("boolean").alias("military_hint"))
    out = row.join(a, "icao24", "left").select(
        "icao24", trim_to_null("callsign").alias("callsign"), "registration", "manufacturer", "model",
        "typecode", "category", "lat", "lon", "heading",
        F.coalesce("geo_altitude", "baro_altitude").alias("altitude"), F.col("velocity").alias("speed"),
        "vertical_rate", F.col("last_contact").alias("last_seen"), "on_ground", "country", "military_hint",
        "year_built", "owner_operator")
    if flat:
        return out
    if photos is not None:
        out = out.join(photos.select("icao24", "photo"), "icao24", "left")
    if include_track:
        pos = positions if ids is None else positions.join(ids, "icao24", "left_semi")
        tr = recent_track(pos, n=track_points, as_array=True)
        out = out.join(tr, "icao24", "left")
    return out
