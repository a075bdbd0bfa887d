"""Activity buckets and the activity time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import pct, round2

# Fixed values -------------------------------------------------------------
DEFAULT_BUCKET_SECONDS = 60
READER_GRID_SECONDS = 60
# Both batch and stream sketches use one size, so they can be merged.
HLL_LG_K = 14
HLL_RSD = 0.0081          # relative error of the store's HyperLogLog
MIN_SERIES_BUCKETS = 12
DEFAULT_SERIES_BUCKETS = 48
DEFAULT_RETENTION_SECONDS = 172_800
# --------------------------------------------------------------------------


def bucket_epoch(ts, width: int) -> F.Column:
    """``floor(t / width) * width`` with width < 1 treated as 1."""
    w = max(1, int(width))
    c = F.col(ts) if isinstance(ts, str) else ts
    return (F.floor(c / F.lit(w)) * F.lit(w)).cast("long")


def bucket_ttl_seconds(width: int, retention: int = DEFAULT_RETENTION_SECONDS) -> int:
    """A bucket lives max(width, retention + width) seconds after its last write."""
    w = max(1, int(width))
    return max(w, retention + w)


def activity_buckets(events: DataFrame, width: int = DEFAULT_BUCKET_SECONDS,
                     time_col: str = "last_contact", mode: str = "exact",
                     key: str = "icao24", military: str = "military_hint") -> DataFrame:
    """Per bucket event counts and distinct aircraft (all / military).

    ``mode='exact'`` uses exact distinct counts (batch); ``'approx'`` uses
    HyperLogLog with the store's error; ``'sketch'`` returns mergeable HLL
    sketches (``aircraft_sketch``, ``military_sketch``) for later re-bucketing."""
    mil = F.coalesce(F.col(military), F.lit(False))
    milkey = F.when(mil, F.col(key))
    g = events.where(F.col(time_col).isNotNull()).groupBy(bucket_epoch(time_col, width).alias("bucket_epoch"))
    base = [F.count(F.lit(1)).alias("events_total"), F.count_if(mil).alias("events_military")]
    if mode == "exact":
        return g.agg(*base, F.count_distinct(F.col(key)).alias("aircraft_total"),
                     F.count_distinct(milkey).alias("aircraft_military"))
    if mode == "approx":
        return g.agg(*base, F.approx_count_distinct(key, HLL_RSD).alias("aircraft_total"),
                     F.approx_count_distinct(milkey, HLL_RSD).alias("aircraft_military"))
    if mode == "sketch":
        return g.agg(*base, F.hll_sketch_agg(key, HLL_LG_K).alias("aircraft_sketch"),
                     F.hll_sketch_agg(milkey, HLL_LG_K).alias("military_sketch"))
    raise ValueError(mode)


def unite_buckets(*tables: DataFrame) -> DataFrame:
    """Sketch buckets of several tables (batch history, stream, corrections) as one
    row per bucket: counts are summed, sketches united, so an aircraft that is in
    more than one table is one aircraft.  The tables' reports must be disjoint for
    the event counts to be so too.  Every table is reduced before the shuffle."""
    names = ["bucket_epoch", "events_total", "events_military", "aircraft_sketch", "military_sketch"]
    rows = tables[0].select(*names)
    for t in tables[1:]:
        rows = rows.unionByName(t.select(*names))
    return rows.where(F.col("bucket_epoch").isNotNull()).groupBy("bucket_epoch").agg(
        *[F.sum(c).cast("long").alias(c) for c in names[1:3]],
        *[F.hll_union_agg(c).alias(c) for c in names[3:]])


def sketch_estimates(buckets: DataFrame) -> DataFrame:
    """Distinct aircraft of sketch buckets (relative error ``HLL_RSD``)."""
    return buckets.select(
        "bucket_epoch", "events_total", "events_military",
        F.hll_sketch_estimate("aircraft_sketch").alias("aircraft_total"),
        F.hll_sketch_estimate("military_sketch").alias("aircraft_military"))


def within_error(estimate, exact, errors: float = 4.0) -> F.Column:
    """Whether a sketch's estimate lies within ``errors`` relative errors of the
    exact count (and at least one aircraft of slack)."""
    e = F.col(estimate) if isinstance(estimate, str) else estimate
    x = F.col(exact) if isinstance(exact, str) else exact
    return F.abs(e - x) <= F.greatest(F.lit(1.0), F.lit(errors * HLL_RSD) * x)


def series_grid(spark, now: int, window_seconds: int, n: int) -> tuple[DataFrame, int, int]:
    """``n`` display buckets of ``max(1, window // n)`` s starting at now − window."""
    window_seconds = max(1, int(window_seconds))
    width = max(1, window_seconds // n)
    start = int(now) - window_seconds
    grid = spark.range(n).select(F.col("id").alias("idx"),
                                 (F.lit(start) + F.col("id") * F.lit(width)).alias("bucket_start"))
    return grid, start, width


def activity_series(minutes: DataFrame, now: int, window_seconds: int,
                    n: int = DEFAULT_SERIES_BUCKETS, distinct: str = "sum") -> DataFrame:
    """Re-bucket minute rows into ``n`` display buckets.

    Minute rows from ``floor(start/60)*60`` to ``now`` are assigned
    ``clamp((minute - start) div width, 0, n-1)``; counts are summed, distinct
    counts too (``distinct='sum'``, as the reference does) or merged from HLL
    sketches (``distinct='merge'``, true per-bucket uniques)."""
    n = max(MIN_SERIES_BUCKETS, int(n))
    grid, start, width = series_grid(minutes.sparkSession, now, window_seconds, n)
    minute_start = (start // READER_GRID_SECONDS) * READER_GRID_SECONDS
    m = minutes.where((F.col("bucket_epoch") >= minute_start) & (F.col("bucket_epoch") <= int(now))
                      & (F.col("bucket_epoch") % READER_GRID_SECONDS == 0))
    off = F.col("bucket_epoch") - F.lit(start)
    # Java integer division truncates toward zero; negative offsets then clamp to 0.
    idx = F.least(F.lit(n - 1).cast("long"),
                  F.when(off < 0, F.lit(0)).otherwise(F.floor(off / F.lit(width))).cast("long"))
    nonempty = ((F.col("events_total") > 0) | (F.col("events_military") > 0))
    if distinct == "merge":
        m = m.where(nonempty)
        agg = m.groupBy(idx.alias("idx")).agg(
            F.sum("events_total").alias("events_total"), F.sum("events_military").alias("events_military"),
            F.hll_sketch_estimate(F.hll_union_agg("aircraft_sketch")).alias("aircraft_total"),
            F.hll_sketch_estimate(F.hll_union_agg("military_sketch")).alias("aircraft_military"),
            F.count(F.lit(1)).alias("_observed"))
    else:
        m = m.where(nonempty | (F.col("aircraft_total") > 0) | (F.col("aircraft_military") > 0))
        agg = m.groupBy(idx.alias("idx")).agg(
            F.sum("events_total").alias("events_total"), F.sum("events_military").alias("events_military"),
            F.sum("aircraft_total").alias("aircraft_total"), F.sum("aircraft_military").alias("aircraft_military"),
            F.count(F.lit(1)).alias("_observed"))
    # The grid has n rows (a parameter, not data), so it is broadcast.
    out = F.broadcast(grid).join(agg, "idx", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select(
        "idx", "bucket_start", z("events_total").alias("events_total"),
        z("events_military").alias("events_military"), z("aircraft_total").alias("aircraft_total"),
        z("aircraft_military").alias("aircraft_military"),
        round2(pct(z("aircraft_military"), z("aircraft_total"))).alias("military_share_pct"),
        (F.coalesce(F.col("_observed"), F.lit(0)) > 0).alias("has_data"))


def impute_gaps(series: DataFrame, count_col: str, has_data: str = "has_data",
                out: str = "filled") -> DataFrame:
    """Buckets without data get max(0, round(avg of known buckets));
    adds ``imputed`` (bool).  All missing -> unchanged.

    The one-row average is attached by an equi-join on a constant key, with
    the aggregate side broadcast (it is a single row)."""
    avg = series.agg(F.avg(F.when(F.col(has_data), F.col(count_col))).alias("_avg")) \
        .withColumn("_one", F.lit(1))
    j = series.withColumn("_one", F.lit(1)).join(F.broadcast(avg), "_one")
    fill = F.greatest(F.lit(0), F.floor(F.col("_avg") + 0.5)).cast("long")
    imputed = ~F.col(has_data) & F.col("_avg").isNotNull()
    return j.select(*series.columns, F.when(imputed, fill).otherwise(F.col(count_col)).cast("long").alias(out),
                    imputed.alias("imputed"))


def series_totals(filled: DataFrame, active: int | DataFrame | None = None) -> DataFrame:
    """A10: total events, summed military aircraft, peak = max(series, active, 1).
    ``active`` is a number or a one-row frame with ``active_aircraft``."""
    act = F.col("active_aircraft") if isinstance(active, DataFrame) else F.lit(int(active or 0))
    out = filled.agg(F.sum("events_total").cast("long").alias("total_events"),
                      F.sum("aircraft_military").cast("long").alias("military_aircraft_sum"),
                      F.count_if("imputed").alias("imputed_buckets"),
                      F.max("filled").alias("_mx"))
    if isinstance(active, DataFrame):  # one row each
        out = out.crossJoin(F.broadcast(active.select("active_aircraft")))
    return out.select(
        "total_events", "military_aircraft_sum", "imputed_buckets",
        F.greatest(F.coalesce(F.col("_mx"), F.lit(0)), act.cast("long"), F.lit(1).cast("long")).alias("peak"))
