"""KPI aggregates over snapshots and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.expr import (bbox_area_km2, counter_label, military_label, pct, round2,
                                    sanitize_typecode)
from skyfold.operators.filters import Bbox

# Fixed values -------------------------------------------------------------
TOP_TYPES = 8
ONLINE_MAX_AGE_SECONDS = 120
MOTION_MIN_MS = 1_000
MOTION_MAX_MS = 20_000
MOTION_FALLBACK_MS = 10_000
# --------------------------------------------------------------------------


def bbox_area_km2_value(b: Bbox) -> float:
    import math
    d_lat = max(0.0, b.max_lat - b.min_lat)
    d_lon = max(0.0, b.max_lon - b.min_lon)
    mid = math.radians((b.min_lat + b.max_lat) / 2.0)
    return max(0.0, (d_lat * 110.574) * (d_lon * 111.320 * math.cos(mid)))


def kpis(snap: DataFrame, bbox: Bbox) -> DataFrame:
    """A3 + A4: active aircraft, traffic density per 10 000 km², military
    share (the defense score is the same number)."""
    area = bbox_area_km2(F.lit(bbox.min_lon), F.lit(bbox.min_lat), F.lit(bbox.max_lon), F.lit(bbox.max_lat))
    a = snap.agg(F.count(F.lit(1)).alias("active_aircraft"),
                 F.count_if(F.coalesce(F.col("military_hint"), F.lit(False))).alias("_mil"))
    share = round2(pct("_mil", "active_aircraft"))
    dens = F.when(area > 0, round2(F.col("active_aircraft") / area * 10000.0)).otherwise(F.lit(0.0))
    return a.select("active_aircraft", dens.alias("traffic_density"), share.alias("military_share"),
                    share.alias("defense_score"))


def breakdown(snap: DataFrame, key: Column, canonical: list[str]) -> DataFrame:
    """A5: counts per key, canonical keys zero-filled and first (``ordinal``),
    extra keys appended after; percent of all rows (round2)."""
    spark = snap.sparkSession
    canon = spark.createDataFrame([(k, i) for i, k in enumerate(canonical)], "key string, ordinal int")
    counts = snap.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("count"))
    total = snap.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))
    j = counts.join(F.broadcast(canon), "key", "full").withColumn("_one", F.lit(1)) \
        .join(F.broadcast(total), "_one")
    return j.select("key", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                    round2(pct(F.coalesce("count", F.lit(0)), "_total")).alias("percent"),
                    F.coalesce("ordinal", F.lit(len(canonical))).alias("ordinal"))


def top_breakdown(snap: DataFrame, key: Column, n: int = TOP_TYPES) -> DataFrame:
    """The ``n`` most frequent keys (count desc, key asc on ties)."""
    counts = snap.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("count"))
    total = snap.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))
    top = counts.orderBy(F.col("count").desc(), F.col("key").asc()).limit(n)
    return top.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select(
        "key", "count", round2(pct("count", "_total")).alias("percent"))


def events_by_attribute(enriched: DataFrame) -> DataFrame:
    """Event counts by category, country, military label and (military
    events only) typecode — one pass, long form (attribute, value, events)."""
    has = F.col("has_metadata")
    cat = counter_label(F.when(has, F.col("category")))
    country = counter_label(F.when(has, F.col("country")), trim=True)
    mil = F.when(has, military_label("military_hint")).otherwise(F.lit("unknown"))
    tc = F.when(mil == "true", sanitize_typecode(F.when(has, F.col("typecode"))))
    pairs = F.array(
        F.struct(F.lit("category").alias("attribute"), cat.alias("value")),
        F.struct(F.lit("country").alias("attribute"), country.alias("value")),
        F.struct(F.lit("military").alias("attribute"), mil.alias("value")),
        F.struct(F.lit("military_typecode").alias("attribute"), tc.alias("value")))
    return (enriched.select(F.inline(pairs)).where(F.col("value").isNotNull())
            .groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("events")))


def enrichment_coverage(enriched: DataFrame) -> DataFrame:
    """Present / missing event counts for year_built and owner_operator."""
    has = F.col("has_metadata")
    yb = has & F.col("year_built").isNotNull()
    ow = has & F.coalesce(F.trim(F.col("owner_operator")) != "", F.lit(False))
    st = lambda c: F.when(c, "present").otherwise("missing")
    pairs = F.array(F.struct(F.lit("year_built").alias("field"), st(yb).alias("status")),
                    F.struct(F.lit("owner_operator").alias("field"), st(ow).alias("status")))
    return (enriched.select(F.inline(pairs)).groupBy("field", "status")
            .agg(F.count(F.lit(1)).alias("events")))


def exact_median(df: DataFrame, value: Column, out: str = "median") -> DataFrame:
    """Exact median (mean of the two middle values when even): one aggregate
    that counts per distinct value, map-side first."""
    return df.agg(F.percentile(value.cast("double"), 0.5).alias(out))


def motion_usable(lat="lat", lon="lon", prev_lat="prev_lat", prev_lon="prev_lon",
                  ts="last_seen", prev_ts="prev_last_seen") -> Column:
    """W8 guard: coordinates present on both sides and time not backwards."""
    fin = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c))
    back = F.col(ts).isNotNull() & F.col(prev_ts).isNotNull() & (F.col(ts) < F.col(prev_ts))
    return fin(lat) & fin(lon) & fin(prev_lat) & fin(prev_lon) & ~back


def median_batch_gap(items: DataFrame, fallback_ms: int = MOTION_FALLBACK_MS,
                     min_ms: int = MOTION_MIN_MS, max_ms: int = MOTION_MAX_MS) -> DataFrame:
    """Median positive (last_seen − prev_last_seen) over usable rows,
    ×1000, clamped; fallback when no delta; no usable row -> no plan (null)."""
    usable = items.where(motion_usable())
    delta = F.col("last_seen") - F.col("prev_last_seen")
    med = exact_median(usable, F.when(delta > 0, delta), "median_gap_s")
    cnt = usable.agg(F.count(F.lit(1)).alias("usable_rows")).withColumn("_one", F.lit(1))
    j = med.withColumn("_one", F.lit(1)).join(cnt, "_one")
    dur = F.least(F.lit(float(max_ms)), F.greatest(F.lit(float(min_ms)),
                  F.coalesce(F.col("median_gap_s") * 1000.0, F.lit(float(fallback_ms)))))
    return j.select("usable_rows", "median_gap_s",
                    F.when(F.col("usable_rows") > 0, dur).alias("duration_ms"))


def feed_freshness(items: DataFrame, now: int, max_age: int = ONLINE_MAX_AGE_SECONDS) -> DataFrame:
    """Newest last_seen, its age, online / stale / unknown."""
    a = items.agg(F.max("last_seen").alias("newest_last_seen"))
    age = F.lit(int(now)) - F.col("newest_last_seen")
    return a.select("newest_last_seen", age.alias("age_seconds"),
                    F.when(F.col("newest_last_seen").isNull(), "unknown")
                    .when(age <= max_age, "online").otherwise("stale").alias("status"))
