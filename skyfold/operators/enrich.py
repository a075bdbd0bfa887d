"""Joins (J1–J8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import category_or_fallback, norm_icao24, norm_optional
from skyfold.functions.taxonomy import airframe_type

# Fixed values -------------------------------------------------------------
PHOTO_TTL_SECONDS = {"available": 7 * 86400, "not_found": 6 * 3600, "rate_limited": 5, "error": 120}
PHOTO_TTL_MINIMUM = {"available": 60, "not_found": 30, "rate_limited": 1, "error": 5}
# --------------------------------------------------------------------------


def aircraft_dim(aircraft: DataFrame, with_owner: bool) -> DataFrame:
    """Enrichment columns of the reference, keyed by canonical icao24."""
    cols = [
        norm_icao24("icao24", validate=False).alias("_ak"),
        category_or_fallback("category_description", "icao_aircraft_class", fallback=None).alias("category"),
        F.col("country"),
        norm_optional("typecode", "upper").alias("typecode"),
        F.col("military_hint").cast("boolean").alias("military_hint"),
    ]
    if with_owner:
        cols.append(F.col("owner_operator"))
    dim = aircraft.select(*cols)
    # Classified once per aircraft on the dimension side, not per position.
    cat = norm_optional("category", "lower").alias("_cat")
    return (dim.select("*", cat)
            .withColumn("airframe_type", airframe_type("_cat", "typecode", normalized=True))
            .drop("_cat"))


def enrich(positions: DataFrame, aircraft: DataFrame, with_owner: bool = False,
           key: str = "icao24") -> DataFrame:
    """Left join on the canonical key; adds category (dashboard fallback,
    null when absent), country, upper typecode, military_hint, airframe_type
    and, only when asked, owner_operator.  No join strategy is forced: Spark
    broadcasts the reference if its measured size allows, and shuffles (and
    splits skewed keys) if not."""
    dim = aircraft_dim(aircraft, with_owner)
    j = positions.withColumn("_pk", norm_icao24(F.col(key), validate=False)).join(
        dim, F.col("_pk") == F.col("_ak"), "left")
    out = j.drop("_pk", "_ak")
    if not with_owner:
        out = out.withColumn("owner_operator", F.lit(None).cast("string"))
    return out


def enrich_events(events: DataFrame, aircraft: DataFrame, key: str = "icao24") -> DataFrame:
    """The processor's per-event lookup (all reference columns, processor
    category fallback ``unknown``); works on a stream (stream-static join)."""
    dim = aircraft.select(
        norm_icao24("icao24", validate=False).alias("_ak"),
        F.lit(True).alias("has_metadata"),
        category_or_fallback("category_description", "icao_aircraft_class", fallback="unknown")
        .alias("category"),
        F.col("country"), F.col("typecode"), F.col("military_hint").cast("boolean").alias("military_hint"),
        F.col("year_built"), F.col("owner_operator"))
    j = events.withColumn("_pk", norm_icao24(F.col(key), validate=False)).join(
        dim, F.col("_pk") == F.col("_ak"), "left")
    return j.drop("_pk", "_ak").withColumn("has_metadata", F.coalesce("has_metadata", F.lit(False)))


def pair_batches(prev: DataFrame, curr: DataFrame, key: str = "icao24") -> DataFrame:
    """start/target pair per aircraft (target = current batch)."""
    p = prev.select(key, *[F.col(c).alias("start_" + c) for c in prev.columns if c != key])
    return curr.join(p, key, "left")


def resolve_photo(by_hex: DataFrame, by_reg: DataFrame, aircraft: DataFrame) -> DataFrame:
    """The hex result, unless it is not_found and the aircraft has a
    registration, in which case the registration result."""
    reg_key = F.upper(F.trim(F.col("registration")))
    a = aircraft.select(norm_icao24("icao24", validate=False).alias("icao24"),
                        F.when(F.length(reg_key) > 0, reg_key).alias("reg_key"))
    h = by_hex.select(F.lower(F.trim("lookup_key")).alias("icao24"), F.col("photo").alias("hex_photo"))
    r = by_reg.select(F.upper(F.trim("lookup_key")).alias("reg_key"), F.col("photo").alias("reg_photo"))
    j = h.join(a, "icao24", "left").join(r, "reg_key", "left")
    use_reg = (F.col("hex_photo.status") == "not_found") & F.col("reg_key").isNotNull()
    return j.select("icao24", "reg_key", F.when(use_reg, F.col("reg_photo")).otherwise(F.col("hex_photo"))
                    .alias("photo"), F.when(use_reg, "reg").otherwise("hex").alias("resolved_by"))


def fresh_photos(cache: DataFrame, now: int, ttl: dict | None = None) -> DataFrame:
    """Cache entries still fresh at ``now``: TTL by status (configured
    value, never below the per-status minimum)."""
    ttl = {**PHOTO_TTL_SECONDS, **(ttl or {})}
    t = {k: max(v, PHOTO_TTL_MINIMUM[k]) for k, v in ttl.items()}
    status = F.col("status")
    ttl_col = (F.when(status == "available", t["available"]).when(status == "not_found", t["not_found"])
               .when(status == "rate_limited", t["rate_limited"]).otherwise(t["error"]))
    return cache.withColumn("ttl_seconds", ttl_col.cast("long")).where(
        F.col("fetched_at") + F.col("ttl_seconds") > F.lit(int(now)))
