"""Canonical schemas (data model M1–M18)."""

from pyspark.sql import types as T

POSITION_FIELDS = [
    ("icao24", T.StringType()),
    ("callsign", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("velocity", T.DoubleType()),
    ("heading", T.DoubleType()),
    ("geo_altitude", T.DoubleType()),
    ("baro_altitude", T.DoubleType()),
    ("vertical_rate", T.DoubleType()),
    ("on_ground", T.BooleanType()),
    ("time_position", T.LongType()),
    ("last_contact", T.LongType()),
    ("ingested_at", T.StringType()),
    ("batch_epoch", T.LongType()),
]

POSITIONS = T.StructType([T.StructField(n, t, True) for n, t in POSITION_FIELDS])

# Wire form of a queued position event: the batch id travels as
# ``opensky_fetch_epoch`` and is renamed to ``batch_epoch`` on read.
WIRE_EVENT = T.StructType(
    [T.StructField(n if n != "batch_epoch" else "opensky_fetch_epoch", t, True)
     for n, t in POSITION_FIELDS])

PREV_FIELDS = [
    ("prev_lat", T.DoubleType()),
    ("prev_lon", T.DoubleType()),
    ("prev_heading", T.DoubleType()),
    ("prev_velocity", T.DoubleType()),
    ("prev_altitude", T.DoubleType()),
    ("prev_last_contact", T.LongType()),
]

LATEST = T.StructType(POSITIONS.fields + [T.StructField(n, t, True) for n, t in PREV_FIELDS])

AIRCRAFT_REQUIRED = [
    "icao24", "country", "category_description", "icao_aircraft_class",
    "manufacturer_icao", "manufacturer_name", "model", "registration", "typecode",
]
AIRCRAFT_OPTIONAL = [
    ("military_hint", T.BooleanType()),
    ("year_built", T.IntegerType()),
    ("owner_operator", T.StringType()),
]
AIRCRAFT = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in AIRCRAFT_REQUIRED]
    + [T.StructField(n, t, True) for n, t in AIRCRAFT_OPTIONAL])

# Header of the reference CSV (camelCase on disk).
AIRCRAFT_CSV_HEADER = [
    "icao24", "country", "categoryDescription", "icaoAircraftClass",
    "manufacturerIcao", "manufacturerName", "model", "registration", "typecode",
]

SUPPLEMENT = T.StructType([
    T.StructField("icao", T.StringType()),
    T.StructField("reg", T.StringType()),
    T.StructField("icaotype", T.StringType()),
    T.StructField("short_type", T.StringType()),
    T.StructField("manufacturer", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("mil", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("ownop", T.StringType()),
])

FETCH_LOG = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("states_count", T.IntegerType()),
    T.StructField("remaining", T.IntegerType()),
    T.StructField("credit_limit", T.IntegerType()),
    T.StructField("reset_at", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("failed", T.BooleanType()),
])

ACTIVITY_MINUTES = T.StructType([
    T.StructField("bucket_epoch", T.LongType()),
    T.StructField("events_total", T.LongType()),
    T.StructField("events_military", T.LongType()),
    T.StructField("aircraft_total", T.LongType()),
    T.StructField("aircraft_military", T.LongType()),
])

METRIC_SAMPLES = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

# VPC flow log record, version 2 default format: 14 space-separated fields.
FLOW_LOG_FIELDS = [
    ("version", "INT"), ("account_id", "STRING"), ("interface_id", "STRING"),
    ("srcaddr", "STRING"), ("dstaddr", "STRING"), ("srcport", "INT"),
    ("dstport", "INT"), ("protocol", "INT"), ("packets", "BIGINT"),
    ("bytes", "BIGINT"), ("start", "BIGINT"), ("end", "BIGINT"),
    ("action", "STRING"), ("log_status", "STRING"),
]
FLOW_LOG_DDL = ", ".join(f"`{n}` {t}" for n, t in FLOW_LOG_FIELDS)

PHOTO = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("thumbnail_url", T.StringType()),
    T.StructField("thumbnail_width", T.IntegerType()),
    T.StructField("thumbnail_height", T.IntegerType()),
    T.StructField("large_thumbnail_url", T.StringType()),
    T.StructField("large_width", T.IntegerType()),
    T.StructField("large_height", T.IntegerType()),
    T.StructField("photographer", T.StringType()),
    T.StructField("source_link", T.StringType()),
])
