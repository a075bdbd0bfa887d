from skyfold.operators.filters import Bbox, continuity_window
from skyfold.operators.latest import build_latest, latest_per_aircraft, with_previous
from skyfold.plans.flights import list_flights
from skyfold.schemas import POSITION_FIELDS

COLS = ", ".join(f"{n} {t.simpleString()}" for n, t in POSITION_FIELDS) + ", event_id bigint"


def pos(spark, recs):
    full = []
    for i, r in enumerate(recs):
        d = {n: None for n, _ in POSITION_FIELDS}
        d.update(r)
        d["event_id"] = r.get("event_id", i)
        full.append(tuple(d[n] for n, _ in POSITION_FIELDS) + (d["event_id"],))
    return spark.createDataFrame(full, COLS)


def test_latest_prefers_newest_last_contact(spark):
    df = pos(spark, [dict(icao24="abc123", last_contact=1700000001, lat=48.0, lon=2.0),
                     dict(icao24="ABC123 ", last_contact=1700000005, lat=48.1, lon=2.1),
                     dict(icao24="def456", last_contact=1700000003, lat=48.2, lon=2.2)])
    got = {r.icao24: r.last_contact for r in latest_per_aircraft(df).collect()}
    assert got == {"abc123": 1700000005, "def456": 1700000003}


def test_continuity_window_and_batch_preference(spark):
    df = pos(spark, [
        dict(icao24="abc001", batch_epoch=101, last_contact=1700000001),
        dict(icao24="abc002", batch_epoch=101, last_contact=1700000002),
        dict(icao24="abc003", batch_epoch=100, last_contact=1700000003),
        dict(icao24="abc002", batch_epoch=100, last_contact=1700099999),
        dict(icao24="abc004", batch_epoch=99, last_contact=1700000004),
        dict(icao24="abc005", batch_epoch=98, last_contact=1700000005)])
    got = {r.icao24: (r.batch_epoch, r.last_contact) for r in latest_per_aircraft(continuity_window(df)).collect()}
    assert set(got) == {"abc001", "abc002", "abc003", "abc004"}
    assert got["abc002"] == (101, 1700000002)


def test_continuity_without_batches_keeps_all(spark):
    df = pos(spark, [dict(icao24="a", last_contact=1), dict(icao24="b", last_contact=2)])
    assert continuity_window(df).count() == 2


def test_with_previous_golden(spark):
    df = pos(spark, [
        dict(icao24="abc123", lat=48.8566, lon=2.3522, velocity=210.0, heading=190.0, geo_altitude=1200.0,
             last_contact=1706000001),
        dict(icao24="abc123", lat=48.9066, lon=2.4022, last_contact=1706000011)])
    r = with_previous(df).orderBy("last_contact").collect()[1]
    assert (r.prev_lat, r.prev_lon, r.prev_velocity, r.prev_heading, r.prev_altitude, r.prev_last_contact) == \
        (48.8566, 2.3522, 210.0, 190.0, 1200.0, 1706000001)


def test_with_previous_baro_fallback_and_chunks(spark):
    df = pos(spark, [dict(icao24="x", baro_altitude=4100.0, last_contact=100),
                     dict(icao24="x", last_contact=100 + 3 * 86400)])
    r = with_previous(df, split_seconds=86400).orderBy("last_contact").collect()
    assert r[0].prev_altitude is None and r[1].prev_altitude == 4100.0 and r[1].prev_last_contact == 100


def test_latest_table_matches_with_previous(spark):
    df = pos(spark, [dict(icao24="a", lat=1.0, lon=1.0, last_contact=t, batch_epoch=t // 10) for t in range(1, 40, 3)])
    lt = build_latest(df).first()
    assert lt.last_contact == 37 and lt.prev_last_contact == 34 and lt.prev_lat == 1.0


def test_sort_limit_golden(spark):
    b = Bbox(0.0, 40.0, 10.0, 60.0)
    df = pos(spark, [dict(icao24=f"abc00{i}", lat=48.0, lon=2.0, last_contact=lc)
                     for i, lc in [(1, 1700000001), (3, 1700000003), (2, 1700000002)]])
    aircraft = spark.createDataFrame([], "icao24 string, country string, category_description string, "
                                         "icao_aircraft_class string, typecode string, military_hint boolean, "
                                         "owner_operator string")
    latest = build_latest(df)
    items = [r.icao24 for r in list_flights(latest, aircraft, bbox=b, limit=2).collect()]
    assert items == ["abc003", "abc002"]
