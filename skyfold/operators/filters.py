"""Filters and predicates (F1–F8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.expr import col_of, norm_optional

# Fixed values -------------------------------------------------------------
DEFAULT_BBOX = (0.9823, 47.9557, 3.7221, 49.7575)  # minLon, minLat, maxLon, maxLat
CONTINUITY_BATCHES = 3
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Bbox:
    """Driver-side parameter object, order minLon, minLat, maxLon, maxLat."""
    min_lon: float
    min_lat: float
    max_lon: float
    max_lat: float

    @classmethod
    def default(cls) -> "Bbox":
        return cls(*DEFAULT_BBOX)

    @classmethod
    def parse(cls, raw: str | None) -> "Bbox":
        if raw is None or not str(raw).strip():
            return cls.default()
        parts = [float(p) for p in str(raw).split(",")]
        if len(parts) != 4:
            raise ValueError("bbox must be minLon,minLat,maxLon,maxLat")
        b = cls(*parts)
        if b.min_lon > b.max_lon or b.min_lat > b.max_lat:
            raise ValueError("bbox min must not exceed max")
        return b


def in_bbox(bbox: Bbox, lat="lat", lon="lon") -> Column:
    """F1 as a filter predicate: inclusive edges; a null coordinate makes the
    predicate null, which a filter drops.  Kept as plain range comparisons so
    the predicate reaches the parquet reader (row-group pruning)."""
    la, lo = col_of(lat), col_of(lon)
    return (la >= bbox.min_lat) & (la <= bbox.max_lat) & (lo >= bbox.min_lon) & (lo <= bbox.max_lon)


def in_bbox_flag(bbox: Bbox, lat="lat", lon="lon") -> Column:
    """F1 as a value: true / false, never null."""
    return F.coalesce(in_bbox(bbox, lat, lon), F.lit(False))


def classify_bbox(bbox: Bbox, lat="lat", lon="lon") -> Column:
    """INSIDE / OUTSIDE / UNKNOWN (null coordinate)."""
    la, lo = col_of(lat), col_of(lon)
    return (F.when(la.isNull() | lo.isNull(), F.lit("UNKNOWN"))
            .when(in_bbox_flag(bbox, la, lo), F.lit("INSIDE")).otherwise(F.lit("OUTSIDE")))


def since_filter(df: DataFrame, since: int | None, col: str = "last_contact") -> DataFrame:
    """keep ``col >= since``; rows with null ``col`` drop only when since is set."""
    return df if since is None else df.where(F.col(col) >= F.lit(int(since)))


def military_filter(df: DataFrame, value: str | None, col: str = "military_hint") -> DataFrame:
    """true / false / unknown (= null)."""
    if value is None:
        return df
    v = value.strip().lower()
    if v == "true":
        return df.where(F.col(col).eqNullSafe(True))
    if v == "false":
        return df.where(F.col(col).eqNullSafe(False))
    if v == "unknown":
        return df.where(F.col(col).isNull())
    return df


def airframe_filter(df: DataFrame, value: str | None, col: str = "airframe_type") -> DataFrame:
    """airplane / helicopter / unknown (= null)."""
    if value is None:
        return df
    v = value.strip().lower()
    if v == "unknown":
        return df.where(F.col(col).isNull())
    return df.where(F.col(col).eqNullSafe(v))


def attr_filter(df: DataFrame, col: str, value: str | None, case: str) -> DataFrame:
    """normalised equality; a null/blank stored value never matches."""
    if value is None or not str(value).strip():
        return df
    want = str(value).strip()
    want = want.lower() if case == "lower" else want.upper()
    return df.where(F.coalesce(norm_optional(col, case) == F.lit(want), F.lit(False)))


def continuity_window(df: DataFrame, k: int = CONTINUITY_BATCHES, batch: str = "batch_epoch") -> DataFrame:
    """F8: keep rows whose batch is one of the ``k`` largest present; if no row
    carries a batch keep everything, otherwise null-batch rows drop.

    The key set is at most ``k`` rows (TakeOrdered over distinct batches), so
    broadcasting it is size-proven; null is one of its keys only when no batch
    is present (nulls sort last and a window of one row says whether they come
    first), and the join is a null-safe equality."""
    top = df.groupBy(F.col(batch).alias("_kb")).agg(F.lit(1).alias("_one")).orderBy(F.col("_kb").desc_nulls_last()).limit(k)
    first = Window.partitionBy("_one").orderBy(F.col("_kb").desc_nulls_last())
    keys = top.withColumn("_max", F.first("_kb").over(first)).where(
        F.col("_kb").isNotNull() | F.col("_max").isNull()).select("_kb")
    return df.join(F.broadcast(keys), F.col(batch).eqNullSafe(F.col("_kb")), "left_semi")
