"""Remaining golden cases of FIXTURES.md §2 (J1+map, A4/A5, A12, A16)."""

from pyspark.sql import functions as F

from skyfold.functions.taxonomy import FLEET_ORDER
from skyfold.operators.enrich import enrich_events
from skyfold.operators.filters import Bbox
from skyfold.operators.metrics import breakdown, events_by_attribute, kpis, median_batch_gap
from skyfold.plans.flights import list_flights
from skyfold.plans.metrics import classified_snapshots
from tests.test_latest import pos

AIRCRAFT_DDL = ("icao24 string, country string, category_description string, icao_aircraft_class string, "
                "manufacturer_icao string, manufacturer_name string, model string, registration string, "
                "typecode string, military_hint boolean, year_built int, owner_operator string")
BOX = Bbox(0.0, 40.0, 10.0, 60.0)


def aircraft(spark, recs):
    full = [r + (None,) * (12 - len(r)) for r in recs]
    return spark.createDataFrame(full, AIRCRAFT_DDL)


def test_enriched_map_item_golden(spark):
    p = pos(spark, [dict(icao24="abc123", lat=48.0, lon=2.0, last_contact=1700000001, batch_epoch=1)])
    a = aircraft(spark, [("abc123", "FR", "Commercial", None, None, None, None, None, "A320", False)])
    from skyfold.operators.latest import build_latest
    r = list_flights(build_latest(p), a, bbox=BOX).first()
    assert (r.airframe_type, r.fleet_type, r.aircraft_size) == ("airplane", "commercial", "large")


def test_metrics_golden(spark):
    p = pos(spark, [dict(icao24=k, lat=48.0, lon=2.0, last_contact=1700000000 + i, batch_epoch=1)
                    for i, k in enumerate(["mil001", "pri001", "unk001"])])
    a = aircraft(spark, [("mil001", "FR", "Military", None, None, None, None, None, "C130", True),
                         ("pri001", "FR", "Business", None, None, None, None, None, "C25A", False, None,
                          "Private Owner")])
    from skyfold.operators.latest import build_latest
    snap = classified_snapshots(build_latest(p), a, BOX, now=1700000010, window_seconds=86400)
    k = kpis(snap, BOX).first()
    assert k.active_aircraft == 3 and k.military_share == 33.33 and k.defense_score == 33.33
    fleet = {r["key"]: r["count"] for r in breakdown(snap, F.col("fleet_type"), FLEET_ORDER).collect()}
    assert fleet == {"commercial": 0, "military": 1, "rescue": 0, "private": 1, "unknown": 1}


def test_attribute_counts_without_metadata(spark):
    ev = spark.createDataFrame([("zzz999",)], "icao24 string")
    a = aircraft(spark, [("abc123", "FR", "Heavy", None, None, None, None, None, "TOO_LONG_TYPECODE", True)])
    got = {(r.attribute, r.value): r.events for r in events_by_attribute(enrich_events(ev, a)).collect()}
    assert got == {("category", "unknown"): 1, ("country", "unknown"): 1, ("military", "unknown"): 1}
    ev = spark.createDataFrame([("abc123",)], "icao24 string")
    got = {(r.attribute, r.value) for r in events_by_attribute(enrich_events(ev, a)).collect()}
    assert ("military_typecode", "unknown") in got and ("military", "true") in got


def test_bootstrap_duration_golden(spark):
    items = spark.createDataFrame([(48.0, 2.0, 48.1, 2.1, 1700000010, 1700000000)],
                                  "lat double, lon double, prev_lat double, prev_lon double, last_seen long, "
                                  "prev_last_seen long")
    assert median_batch_gap(items).first().duration_ms == 10000.0
    items = spark.createDataFrame([(48.0, 2.0, 48.1, 2.1, 1700000010, None)],
                                  "lat double, lon double, prev_lat double, prev_lon double, last_seen long, "
                                  "prev_last_seen long")
    assert median_batch_gap(items, fallback_ms=8000).first().duration_ms == 8000.0
