"""Scalar column expressions (N1–N20).  All are Catalyst built-ins: they stay
inside whole-stage codegen and need no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "trim_ctl", "trim_to_null", "norm_optional", "py_strip_to_null",
    "norm_icao24", "to_bool_flag", "to_year", "altitude", "epoch_or_iso_to_epoch",
    "category_or_fallback", "military_label", "sanitize_typecode", "round2", "pct",
    "haversine_km", "lerp", "lerp_heading", "knots_to_kmh", "bbox_area_deg2",
    "bbox_area_km2", "scale_bbox", "photo_status_from_http", "counter_label",
    "ntz_epoch_seconds", "ICAO24_PATTERN",
]

# Fixed values -------------------------------------------------------------
ICAO24_PATTERN = "^[0-9a-f]{6}$"
TRUE_WORDS = ["1", "true", "yes", "y"]
FALSE_WORDS = ["0", "false", "no", "n"]
EARTH_RADIUS_KM = 6371.0
KM_PER_DEG_LAT = 110.574
KM_PER_DEG_LON_EQUATOR = 111.320
KNOTS_TO_KMH = 1.852
# --------------------------------------------------------------------------

# Java String.trim() strips every code point <= U+0020 from both ends.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
# Python str.strip() strips Unicode white space (NBSP, ideographic space, ...).
_PY_STRIP = r"^[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}\x{85}]+|[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}\x{85}]+$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ctl(c) -> Column:
    """Java-style trim (control characters and space)."""
    return F.regexp_replace(col_of(c), _JAVA_TRIM, "")


def trim_to_null(c) -> Column:
    """Trim, blank -> null."""
    t = trim_ctl(c)
    return F.when(F.length(t) > 0, t)


def norm_optional(c, case: str | None = None) -> Column:
    """Trim, blank -> null, then ``lower`` / ``upper``."""
    t = trim_to_null(c)
    if case == "lower":
        return F.lower(t)
    if case == "upper":
        return F.upper(t)
    return t


def py_strip_to_null(c) -> Column:
    """The builder's normaliser: Python ``strip`` (Unicode white space)."""
    t = F.regexp_replace(col_of(c), _PY_STRIP, "")
    return F.when(F.length(t) > 0, t)


def norm_icao24(c, validate: bool = True, python_strip: bool = False) -> Column:
    """Trim, lower, optionally require six hex digits."""
    v = F.lower(py_strip_to_null(c) if python_strip else trim_to_null(c))
    return F.when(v.rlike(ICAO24_PATTERN), v) if validate else v


def to_bool_flag(c) -> Column:
    """Boolean / integer / yes-no words -> 0/1, anything else -> null.

    Works on a string column holding the JSON text of the value
    (``true``, ``1``, ``"yes"``)."""
    s = F.lower(F.trim(F.regexp_replace(col_of(c).cast("string"), '^"|"$', "")))
    num = s.try_cast("double") if hasattr(s, "try_cast") else F.expr("NULL")
    return (F.when(s.isin(TRUE_WORDS), F.lit(1))
            .when(s.isin(FALSE_WORDS), F.lit(0))
            .when(num.isNotNull() & s.rlike(r"^-?\d+$"), F.when(num != 0, 1).otherwise(0)))


def to_year(c) -> Column:
    """Digits only, within 1900..2100."""
    s = F.trim(F.regexp_replace(col_of(c).cast("string"), '^"|"$', ""))
    # leading zeros go first: what is left of a year in range has four digits
    return F.regexp_extract(s, r"^0*(19\d\d|20\d\d|2100)$", 1).try_cast("int")


def altitude(geo="geo_altitude", baro="baro_altitude") -> Column:
    """Geometric altitude, else barometric."""
    return F.coalesce(col_of(geo), col_of(baro))


def epoch_or_iso_to_epoch(c, strict: bool = False) -> Column:
    """Digits (> 1e10 are milliseconds) or an ISO-8601 date-time with an
    offset (seconds and up to nine fraction digits optional) -> epoch s.

    Blank input is null.  Input that is neither is null too, or an error if
    ``strict`` (what the query parameter does); ``unreadable_epoch`` tells such
    rows apart for a reject path."""
    s = F.upper(trim_to_null(c))
    n = F.when(s.rlike(r"^\d+$"), s.try_cast("bigint"))
    iso = s.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:\d\d)$")
    out = F.coalesce(F.when(n > 10_000_000_000, F.floor(n / 1000).cast("long")).otherwise(n),
                     F.when(iso, F.unix_seconds(
                         F.regexp_replace(s, r"^(.{10}T\d\d:\d\d)([Z+-])", "$1:00$2").try_cast("timestamp"))))
    if not strict:
        return out
    return F.when(s.isNotNull() & out.isNull(), F.raise_error(F.concat(F.lit("not an epoch or date-time: "), s))
                  .cast("long")).otherwise(out)


def unreadable_epoch(c) -> Column:
    """True for non-blank input that ``epoch_or_iso_to_epoch`` cannot read."""
    return trim_to_null(c).isNotNull() & epoch_or_iso_to_epoch(c).isNull()


def category_or_fallback(category="category_description", klass="icao_aircraft_class",
                         fallback: str | None = "unknown") -> Column:
    """Category, else aircraft class, else ``unknown`` (processor) / null (dashboard)."""
    cat = col_of(category)
    kls = col_of(klass)
    out = (F.when(trim_to_null(cat).isNotNull(), cat)
           .when(trim_to_null(kls).isNotNull(), kls))
    return out.otherwise(F.lit(fallback)) if fallback is not None else out


def military_label(c="military_hint") -> Column:
    """Three-valued hint as a label."""
    h = col_of(c)
    return F.when(h.isNull(), "unknown").when(h, "true").otherwise("false")


def sanitize_typecode(c="typecode") -> Column:
    """Trim + upper; blank or longer than 8 -> ``unknown``."""
    t = F.upper(trim_to_null(c))
    return F.when(t.isNotNull() & (F.length(t) <= 8), t).otherwise(F.lit("unknown"))


def round2(x) -> Column:
    """Java ``Math.round(x*100)/100`` (half rounds up, toward +inf)."""
    return F.floor(col_of(x) * 100.0 + 0.5) / 100.0


def pct(n, total) -> Column:
    """Percentage, 0 when total <= 0."""
    t = col_of(total)
    return F.when(t > 0, col_of(n) * 100.0 / t).otherwise(F.lit(0.0))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance, R = 6371 km."""
    la1, lo1, la2, lo2 = (F.radians(col_of(x)) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def lerp(a, b, p) -> Column:
    """Null-safe linear interpolation; falls back to ``b``."""
    a, b, p = col_of(a), col_of(b), col_of(p)
    return F.when(a.isNull() | b.isNull(), b).otherwise(a + (b - a) * p)


def lerp_heading(a, b, p) -> Column:
    """Shortest-arc heading interpolation, wrapped to [0, 360)."""
    a, b, p = col_of(a), col_of(b), col_of(p)
    delta = ((b - a + 540.0) % 360.0) - 180.0
    raw = a + delta * p
    wrapped = ((raw % 360.0) + 360.0) % 360.0
    return F.when(a.isNull() | b.isNull(), b).otherwise(wrapped)


def knots_to_kmh(c) -> Column:
    """Explicit knot -> km/h conversion, one decimal."""
    return F.round(col_of(c) * KNOTS_TO_KMH, 1)


def bbox_area_deg2(min_lon, min_lat, max_lon, max_lat) -> Column:
    """Rectangle area in square degrees (never negative)."""
    return F.greatest(F.lit(0.0), (col_of(max_lon) - col_of(min_lon)) * (col_of(max_lat) - col_of(min_lat)))


def bbox_area_km2(min_lon, min_lat, max_lon, max_lat) -> Column:
    """Approximate area in km² (flat-earth at mid latitude)."""
    d_lat = F.greatest(F.lit(0.0), col_of(max_lat) - col_of(min_lat))
    d_lon = F.greatest(F.lit(0.0), col_of(max_lon) - col_of(min_lon))
    mid = F.radians((col_of(min_lat) + col_of(max_lat)) / 2.0)
    return F.greatest(F.lit(0.0), (d_lat * KM_PER_DEG_LAT) * (d_lon * KM_PER_DEG_LON_EQUATOR * F.cos(mid)))


def scale_bbox(min_lon, min_lat, max_lon, max_lat, factor) -> dict:
    """Grow half-extents by sqrt(max(1, factor)) around the centre,
    clamped to the globe.  Returns four columns."""
    f = F.sqrt(F.greatest(F.lit(1.0), col_of(factor).cast("double")))
    clon = (col_of(min_lon) + col_of(max_lon)) / 2.0
    clat = (col_of(min_lat) + col_of(max_lat)) / 2.0
    hlon = (col_of(max_lon) - col_of(min_lon)) / 2.0 * f
    hlat = (col_of(max_lat) - col_of(min_lat)) / 2.0 * f
    return {
        "min_lon": F.greatest(F.lit(-180.0), clon - hlon),
        "min_lat": F.greatest(F.lit(-90.0), clat - hlat),
        "max_lon": F.least(F.lit(180.0), clon + hlon),
        "max_lat": F.least(F.lit(90.0), clat + hlat),
    }


def photo_status_from_http(code) -> Column:
    """HTTP status -> photo status (2xx handled by the payload parser)."""
    c = col_of(code)
    return (F.when(c == 429, "rate_limited").when(c == 404, "not_found")
            .when((c >= 200) & (c < 300), F.lit(None).cast("string")).otherwise("error"))


def counter_label(c, trim: bool = False) -> Column:
    """Blank -> ``unknown``; country labels are trimmed."""
    v = col_of(c)
    ok = trim_to_null(v).isNotNull()
    return F.when(ok, trim_ctl(v) if trim else v).otherwise(F.lit("unknown"))


def ntz_epoch_seconds(c) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ (or TIMESTAMP) independent of the session zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({c} as timestamp_ntz))") \
        if isinstance(c, str) else F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                                    c.cast("timestamp_ntz"))

