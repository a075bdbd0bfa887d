"""Composite metrics queries: flights metrics (Q3) and the KPI strip (Q5)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.expr import round2
from skyfold.functions.taxonomy import (FLEET_ORDER, SIZE_ORDER, aircraft_size, aircraft_type_label,
                                        fleet_type, normalized_columns)
from skyfold.operators.activity import (DEFAULT_SERIES_BUCKETS, MIN_SERIES_BUCKETS, activity_buckets,
                                        activity_series, impute_gaps, series_totals)
from skyfold.operators.enrich import enrich_events
from skyfold.operators.filters import Bbox
from skyfold.operators.metrics import breakdown, kpis, top_breakdown
from skyfold.plans.flights import snapshots

# Fixed values -------------------------------------------------------------
DEFAULT_WINDOW = "24h"
MAX_WINDOW_SECONDS = 168 * 3600
KPI_TOP = 3
# estimates that the answer declares and does not compute
PLANNED = {"takeoffsLandings": "planned_v1_1", "noiseProxyIndex": "planned_v1_1_heuristic",
           "alerts": "out_of_scope_issue_129"}
# --------------------------------------------------------------------------


def parse_window(raw: str | None, default: str = DEFAULT_WINDOW, max_seconds: int = MAX_WINDOW_SECONDS) -> int:
    """``\\d+[mhd]`` -> seconds (default 24 h, capped at 168 h)."""
    v = (raw or default).strip().lower()
    m = re.fullmatch(r"(\d+)([mhd])", v)
    if not m:
        raise ValueError("window must match \\d+[mhd]")
    secs = int(m.group(1)) * {"m": 60, "h": 3600, "d": 86400}[m.group(2)]
    if secs <= 0:
        raise ValueError("window must be positive")
    return min(secs, max_seconds)


@dataclass
class MetricsResult:
    kpis: DataFrame
    fleet: DataFrame
    sizes: DataFrame
    types: DataFrame
    series: DataFrame


def classified_snapshots(latest, aircraft, bbox: Bbox, now: int, window_seconds: int) -> DataFrame:
    snap = snapshots(latest, aircraft, bbox, since=int(now) - window_seconds, with_owner=True)
    s = normalized_columns(snap)
    return s.select(
        "*",
        fleet_type("military_hint", "_cs", "_cat", "_own", normalized=True).alias("fleet_type"),
        aircraft_size("_cat", "_tc", normalized=True).alias("aircraft_size"),
        aircraft_type_label("category", "typecode").alias("type_label"))


def activity_minutes(positions: DataFrame, aircraft: DataFrame, time_col: str = "last_contact",
                     mode: str = "exact") -> DataFrame:
    """Minute activity table (A7 at 60 s) from positions enriched per event."""
    ev = enrich_events(positions.where(F.col("icao24").isNotNull()), aircraft)
    return activity_buckets(ev, 60, time_col=time_col, mode=mode)


def flights_metrics(latest: DataFrame, positions: DataFrame, aircraft: DataFrame, now: int,
                    bbox: Bbox | None = None, window: str | None = None,
                    buckets: int = DEFAULT_SERIES_BUCKETS) -> MetricsResult:
    """Q3: snapshot KPIs, breakdowns and the activity series.

    The classified snapshot is a plan that four of the answers share; a caller
    that takes them all writes it once (``session.materialized``)."""
    bbox = bbox or Bbox.default()
    w = parse_window(window)
    n = max(MIN_SERIES_BUCKETS, buckets)
    snap = classified_snapshots(latest, aircraft, bbox, now, w)
    k = kpis(snap, bbox).select("*", F.lit(max(1, w // n)).cast("long").alias("activity_bucket_seconds"),
                                F.lit(max(1, w)).cast("long").alias("activity_window_seconds"))
    # only the window's positions are aggregated; the bounds reach the scan
    start = (int(now) - max(1, w)) // 60 * 60
    recent = positions.where((F.col("last_contact") >= start) & (F.col("last_contact") < int(now) // 60 * 60 + 60))
    series = activity_series(activity_minutes(recent, aircraft), now, w, n)
    return MetricsResult(
        kpis=k,
        fleet=breakdown(snap, F.col("fleet_type"), FLEET_ORDER),
        sizes=breakdown(snap, F.col("aircraft_size"), SIZE_ORDER),
        types=top_breakdown(snap, F.col("type_label")),
        series=series)


def metrics_answer(m: MetricsResult, credits: DataFrame | None = None, generated_at: str | None = None) -> DataFrame:
    """Q3 as one row with every field of the answer.

    The lists are bounded: the canonical and extra keys of a breakdown, the top
    types, and the series' grid.  ``credits`` is W13's ratio by instance; the answer
    takes the first instance by name, null without samples.  The estimates are
    null and their notes say why."""
    def listed(df: DataFrame, order: list, fields: list, out: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*order, *fields))).alias(out))
    item = ["key", "count", "percent"]
    keep = lambda out, names: F.transform(out, lambda x: F.struct(*[x[n].alias(n) for n in names])).alias(out)
    parts = [
        listed(m.fleet, ["ordinal"], item, "fleet_breakdown").select(keep("fleet_breakdown", item)),
        listed(m.sizes, ["ordinal"], item, "aircraft_sizes").select(keep("aircraft_sizes", item)),
        listed(m.types.withColumn("_o", -F.col("count")), ["_o"], item, "aircraft_types").select(
            keep("aircraft_types", item)),
    ]
    bucket = ["bucket_start", "events_total", "events_military", "aircraft_total", "aircraft_military",
              "military_share_pct", "has_data"]
    parts.append(listed(m.series, [], bucket, "activity_series"))
    ratio = "opensky_credits_per_request_24h"
    if credits is not None:
        parts.append(credits.agg(round2(F.min_by("credits_per_request_24h", "instance")).alias(ratio)))
    out = m.kpis
    for p in parts:  # one row each
        out = out.crossJoin(F.broadcast(p))
    if credits is None:
        out = out.withColumn(ratio, F.lit(None).cast("double"))
    none = F.lit(None).cast("double")
    estimates = F.struct(none.alias("takeoffs_window"), none.alias("landings_window"), none.alias("noise_proxy_index"),
                         F.create_map(*[F.lit(x) for kv in PLANNED.items() for x in kv]).alias("notes"))
    return out.withColumn("estimates", estimates).withColumn(
        "generated_at", F.lit(generated_at) if generated_at else F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def kpi_strip(m: MetricsResult) -> dict:
    """Q5: top-3 fleet / size / type, imputed aircraft series, totals and the
    dominant fleet."""
    top = lambda df: df.orderBy(F.col("count").desc(), F.col("ordinal").asc() if "ordinal" in df.columns
                                else F.col("key").asc()).limit(KPI_TOP)
    filled = impute_gaps(m.series, "aircraft_total")
    return {"top_fleet": top(m.fleet), "top_sizes": top(m.sizes), "top_types": top(m.types),
            "filled_series": filled, "totals": kpi_totals(m)}


def kpi_strip_rows(m: MetricsResult) -> DataFrame:
    """Q5 as one table: (part, position, key, value) of the three top lists and
    the filled series."""
    s = kpi_strip(m)
    out = None
    for part in ("top_fleet", "top_sizes", "top_types"):
        order = F.col("ordinal") if "ordinal" in s[part].columns else F.col("key")
        rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("count").desc(), order))  # three rows
        rows = s[part].select(F.lit(part).alias("part"), rank.cast("long").alias("position"), "key",
                              F.col("count").cast("long").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    series = s["filled_series"].select(F.lit("series").alias("part"), F.col("idx").alias("position"),
                                       F.when(F.col("imputed"), "imputed").otherwise("measured").alias("key"),
                                       F.col("filled").alias("value"))
    return out.unionByName(series)


def kpi_totals(m: MetricsResult) -> DataFrame:
    """Q5 one-row summary: series totals, peak and dominant fleet."""
    total = series_totals(impute_gaps(m.series, "aircraft_total"), m.kpis)
    military = impute_gaps(m.series, "aircraft_military", out="filled_military").agg(
        F.count_if("imputed").alias("imputed_military_buckets"))
    dominant = m.fleet.agg(F.max_by("key", F.struct(F.col("count"), -F.col("ordinal"))).alias("dominant_fleet"))
    return total.crossJoin(F.broadcast(military)).crossJoin(F.broadcast(dominant)).select(  # one row each
        "total_events", "military_aircraft_sum", "imputed_buckets", "imputed_military_buckets", "peak", "dominant_fleet")
