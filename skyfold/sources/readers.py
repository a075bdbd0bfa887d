"""Event sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import norm_icao24, trim_ctl, trim_to_null
from skyfold.operators.filters import classify_bbox
from skyfold.operators.sequence import materialize
from skyfold.schemas import POSITION_FIELDS

EVENT_ORDER = ("last_contact", "batch_epoch", "event_id")

# Fixed values -------------------------------------------------------------
# Positional cells of an upstream state vector.
CELL_ICAO24, CELL_CALLSIGN, CELL_TIME_POSITION, CELL_LAST_CONTACT = 0, 1, 3, 4
CELL_LON, CELL_LAT, CELL_BARO_ALT, CELL_ON_GROUND = 5, 6, 7, 8
CELL_VELOCITY, CELL_HEADING, CELL_GEO_ALT = 9, 10, 13
# --------------------------------------------------------------------------


def _cell(i: int, typ: str):
    return F.expr(f"try_variant_get(_row, '$[{i}]', '{typ}')")


def read_state_responses(responses: DataFrame, body: str = "body",
                         fetched_at: str = "fetched_at") -> tuple[DataFrame, DataFrame]:
    """Explode positional state arrays into state rows.

    A body whose ``states`` is not an array yields no rows; inside the array
    only array rows are states (siblings of a bad row are kept); a body that
    is not JSON becomes an error row.  Returns (states, errors)."""
    v = materialize(responses, _v=F.expr(f"try_parse_json({body})"))
    errors = v.where(F.col("_v").isNull()).drop("_v").withColumn("error", F.lit("malformed_json"))
    rows = (v.where(F.col("_v").isNotNull())
            .select(F.col(fetched_at).alias("_fetched_at"),
                    F.explode(F.expr("try_variant_get(_v, '$.states', 'array<variant>')")).alias("_row"))
            .where(F.coalesce(F.expr("schema_of_variant(_row)").startswith("ARRAY"), F.lit(False))))
    text = lambda i: trim_ctl(_cell(i, "string"))
    states = rows.select(
        text(CELL_ICAO24).alias("icao24"), text(CELL_CALLSIGN).alias("callsign"),
        _cell(CELL_LAT, "double").alias("latitude"), _cell(CELL_LON, "double").alias("longitude"),
        _cell(CELL_VELOCITY, "double").alias("velocity"), _cell(CELL_HEADING, "double").alias("heading"),
        _cell(CELL_GEO_ALT, "double").alias("geo_altitude"), _cell(CELL_BARO_ALT, "double").alias("baro_altitude"),
        _cell(CELL_ON_GROUND, "boolean").alias("on_ground"),
        _cell(CELL_TIME_POSITION, "bigint").alias("time_position"),
        _cell(CELL_LAST_CONTACT, "bigint").alias("last_contact"), "_fetched_at")
    return states, errors


def to_events(states: DataFrame, batch_col: str = "_fetched_at") -> DataFrame:
    """State rows -> position events (latitude -> lat, longitude -> lon,
    batch id from the poll).  vertical_rate is never produced (null)."""
    return states.select(
        "icao24", "callsign", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "velocity",
        "heading", "geo_altitude", "baro_altitude", F.lit(None).cast("double").alias("vertical_rate"),
        "on_ground", "time_position", "last_contact", F.lit(None).cast("string").alias("ingested_at"),
        F.col(batch_col).cast("long").alias("batch_epoch"))


def publish_events(events: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """K1: one JSON payload per event, ``ingested_at`` stamped (ISO-8601),
    batch id on the wire as ``opensky_fetch_epoch``.  Returns a ``value``
    column for ``write.text`` / a Kafka sink."""
    stamp = F.lit(ingested_at) if ingested_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    cols = [F.col(n).alias(n) for n, _ in POSITION_FIELDS if n not in ("ingested_at", "batch_epoch")]
    payload = F.struct(*cols, F.col("batch_epoch").alias("opensky_fetch_epoch"), stamp.alias("ingested_at"))
    return events.select(F.to_json(payload).alias("value"))


def read_position_events(payloads: DataFrame, value: str = "value") -> DataFrame:
    """JSON payloads with an explicit schema; unknown fields ignored,
    missing and null fields null.  Scalars are coerced as the queue's reader
    does it (numeric strings to numbers, numbers to strings, a blank string to
    a null number).  ``_corrupt`` holds payloads that are not a JSON object, and
    those with a field that is there but cannot be read as its type.

    Every payload is parsed once, into a variant; every field is read off it."""
    keep = [c for c in payloads.columns if c != value]
    wire = {n: ("opensky_fetch_epoch" if n == "batch_epoch" else n) for n, _ in POSITION_FIELDS}
    typed = [(n, t.simpleString()) for n, t in POSITION_FIELDS if t.simpleString() != "string"]
    as_struct = lambda fields: F.expr(
        "try_variant_get(_v, '$', 'struct<" + ",".join(f"{wire[n]}:{t}" for n, t in fields) + ">')")
    parsed = materialize(payloads.select(*keep, F.col(value).alias("_raw")), _v=F.expr("try_parse_json(_raw)"))
    # every field as text and as its type, one walk over the payload each
    parsed = materialize(parsed, _t=as_struct([(n, "string") for n, _ in POSITION_FIELDS]), _e=as_struct(typed))
    is_typed = {n for n, _ in typed}
    fields, bad = [], F.col("_t").isNull()  # not an object
    for n, _ in POSITION_FIELDS:
        text = F.col("_t")[wire[n]]
        if n not in is_typed:
            # only an array or object has text that starts so and a nested type
            nested = text.rlike(r"^[\[{]") & F.expr(
                f"schema_of_variant(try_variant_get(_v, '$.{wire[n]}', 'variant'))").rlike("^(ARRAY|OBJECT)")
            fields.append(text.alias(n))
            bad = bad | F.coalesce(nested, F.lit(False))
        else:
            value_of = F.col("_e")[wire[n]]
            fields.append(value_of.alias(n))
            bad = bad | (value_of.isNull() & F.coalesce(trim_to_null(text).isNotNull(), F.lit(False)))
    return parsed.select(*keep, *fields, F.when(bad, F.col("_raw")).alias("_corrupt"))


def route_events(parsed: DataFrame) -> DataFrame:
    """F7 on parsed payloads: ``_route`` is ``ok`` or ``dead`` (corrupt, or a
    key that is blank after trimming control characters and spaces).  The key is
    trimmed and lower-cased once here so every downstream key is canonical."""
    k = norm_icao24("icao24", validate=False)
    dead = F.col("_corrupt").isNotNull() | k.isNull()
    return parsed.withColumn("_route", F.when(dead, F.lit("dead")).otherwise(F.lit("ok"))).withColumn(
        "icao24", F.when(dead, F.col("icao24")).otherwise(k))


def split_events(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters).  Each side parses the payloads by itself;
    where both are needed together, take ``route_events``."""
    d = route_events(parsed)
    return (d.where(F.col("_route") == "ok").drop("_corrupt", "_route"),
            d.where(F.col("_route") == "dead").drop("_route"))


def routed_health(routed: DataFrame, bbox) -> DataFrame:
    """A15 from one parsed frame (``route_events``): processed and error counts,
    last processed epoch, and the members inside the box."""
    inside = classify_bbox(bbox)
    ok = F.col("_route") == "ok"
    # per aircraft first (map-side), so that the payloads are read and parsed once
    per = routed.groupBy(F.when(ok, F.col("icao24")).alias("k")).agg(
        F.count_if(ok).alias("n"), F.count_if(~ok).alias("e"), F.max(F.when(ok, F.col("last_contact"))).alias("t"),
        F.max_by(F.when(ok, inside), F.when(ok & (inside != "UNKNOWN"), F.struct(*EVENT_ORDER))).alias("at"))
    return per.agg(F.sum("n").alias("processed"), F.sum("e").alias("errors"), F.max("t").alias("last_processed_epoch"),
                   F.count_if(F.col("at") == "INSIDE").alias("members_inside")).select(
        F.coalesce("processed", F.lit(0)).alias("processed"), F.coalesce("errors", F.lit(0)).alias("errors"),
        "last_processed_epoch", "members_inside")


def pipeline_health(valid: DataFrame, errors: DataFrame, members: DataFrame) -> DataFrame:
    """Processed and error counts, last processed epoch, members inside."""
    one = lambda df: df.withColumn("_one", F.lit(1))
    a = one(valid.agg(F.count(F.lit(1)).alias("processed"), F.max("last_contact").alias("last_processed_epoch")))
    b = one(errors.agg(F.count(F.lit(1)).alias("errors")))
    c = one(members.agg(F.count(F.lit(1)).alias("members_inside")))
    return a.join(b, "_one").join(c, "_one").select("processed", "errors", "last_processed_epoch", "members_inside")
