"""Nothing is lost, replays change nothing, reading stays bounded."""

import os

import pytest
from pyspark.sql import functions as F

from skyfold.streaming import routing as R
from skyfold.streaming import streams as St
from skyfold.streaming.read_model import ReadModel

EVENT = "icao24 string, event_id long, callsign string, lat double, lon double, heading double, velocity double, " \
        "geo_altitude double, baro_altitude double, on_ground boolean, last_contact long, batch_epoch long"
AIRCRAFT = "icao24 string, country string, category string, category_description string, icao_aircraft_class string, " \
           "typecode string, military_hint boolean, year_built int, owner_operator string"


def events(spark, rows):
    return spark.createDataFrame(
        [(k, e, None, la, lo, None, None, None, None, None, lc, lc) for k, e, la, lo, lc in rows], EVENT)


@pytest.fixture()
def aircraft(spark):
    return spark.createDataFrame([("a", "FR", None, "Heavy", None, "A320", True, None, None)], AIRCRAFT)


BATCHES = [
    [("a", 1, 48.5, 2.0, 1000), ("a", 2, None, None, None), ("b", 3, 10.0, 2.0, 1010)],
    [("a", 4, 48.6, 2.1, 9000), ("c", 5, 48.6, 2.1, 1030)],
    [("a", 6, 48.7, 2.2, 1015), ("b", 7, 48.6, 2.1, 1500), ("c", 8, 48.6, 2.1, 1031)],
    [("b", 9, 48.6, 2.1, 9001), ("c", 10, 10.0, 2.1, 9002)],
]


def contents(model):
    latest = {r.icao24: (r.event_id, r.prev_last_contact, r.events, r.track_points, r.inside) for r in model.latest().collect()}
    activity = {r.bucket_epoch: (r.events_total, r.events_military, r.aircraft_total, r.late_events)
                for r in model.activity().collect()}
    country = {r.value: r.events for r in model.table("attributes").where("attribute = 'country'").collect()}
    return latest, activity, country


WANT = ({"a": (4, 1015, 4, 4, True), "b": (9, 1500, 3, 3, True), "c": (10, 1031, 3, 3, False)},
        {960: (3, 2, 2, 1), 1020: (2, 0, 1, 1), 1500: (1, 0, 1, 1), 9000: (3, 1, 3, 0), None: (1, 1, 1, 0)},
        {"FR": 4, "unknown": 6})


@pytest.mark.parametrize("max_deltas", [1, 8])
def test_tables_after_every_batch_replay_and_compaction(spark, tmpdir_path, aircraft, max_deltas):
    model = ReadModel(spark, os.path.join(tmpdir_path, "rm"), max_deltas=max_deltas)
    for i, rows in enumerate(BATCHES):
        model.apply(events(spark, rows), aircraft, i)
        model.apply(events(spark, rows), aircraft, i)  # a replay
        assert all(len(t["deltas"]) <= max_deltas for t in model.current()["tables"].values())
        assert len(model.manifests()) <= 3 + max_deltas
    assert contents(model) == WANT
    model.compact()
    assert contents(model) == WANT
    assert ReadModel(spark, os.path.join(tmpdir_path, "rm")).current()["through"] == len(BATCHES) - 1


def test_a_reader_keeps_its_files_while_the_model_is_compacted(spark, tmpdir_path, aircraft):
    model = ReadModel(spark, os.path.join(tmpdir_path, "rm"))
    model.apply(events(spark, BATCHES[0]), aircraft, 0)
    held = model.table("activity")  # planned on the files of now
    model.compact()
    assert held.agg(F.sum("events_total")).first()[0] == 3


def test_an_uncommitted_delta_is_written_anew(spark, tmpdir_path, aircraft):
    """A driver that ends between the delta and the manifest."""
    model = ReadModel(spark, os.path.join(tmpdir_path, "rm"))
    model.apply(events(spark, BATCHES[0]), aircraft, 0)
    commit, model._commit = model._commit, lambda m: (_ for _ in ()).throw(KeyboardInterrupt())
    with pytest.raises(KeyboardInterrupt):
        model.apply(events(spark, BATCHES[1]), aircraft, 1)
    again = ReadModel(spark, os.path.join(tmpdir_path, "rm"))
    assert again.table("activity").agg(F.sum("events_total")).first()[0] == 3
    for i, rows in enumerate(BATCHES[1:], 1):
        again.apply(events(spark, rows), aircraft, i)
    assert contents(again) == WANT


def test_expiry_lists_buckets_and_removes_their_files(spark, tmpdir_path, aircraft):
    path = os.path.join(tmpdir_path, "rm")
    model = ReadModel(spark, path)
    for i, rows in enumerate(BATCHES):
        model.apply(events(spark, rows), aircraft, i)
    before = {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if "activity" in d and f.endswith(".parquet")}
    gone = {(r.bucket_epoch, r.events_total, r.expired_at) for r in model.expire(5000, 3000).collect()}
    assert gone == {(960, 3, 4020), (1020, 2, 4080), (1500, 1, 4560)}
    assert model.expire(5001, 3000).count() == 0  # once only
    assert {r.bucket_epoch for r in model.activity().collect()} == {9000, None}
    model.vacuum(1)
    assert not any(os.path.exists(f) for f in before)
    assert contents(model)[0] == WANT[0]


def test_every_row_leaves_with_a_route(spark, tmpdir_path):
    """Six out-of-order micro-batches, one watermark of 600 s over all aircraft."""
    schema = "icao24 string, event_id long, last_contact long"
    batches = [[("a", 1, 10_000), ("x", 8, None)], [("a", 2, 20_000), ("a", 2, 20_000)],
               [("b", 3, 5_000), ("a", 9, 20_000)], [("c", 4, 21_000), ("a", 5, 19_400), ("a", 6, 19_399)],
               [("a", 7, 20_400), ("a", 10, 19_400)], [("a", 11, 20_399), ("c", 12, 21_000), ("c", 13, 30_000)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmpdir_path}/in/b{i}")
        src = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in/*")
        St.run_available_now(R.routed_sink(R.route_events(src, 600), f"{tmpdir_path}/out", f"{tmpdir_path}/ck"))
    got = sorted((r.event_id, r.route) for r in spark.read.parquet(f"{tmpdir_path}/out").collect())
    assert got == [(1, "passed"), (2, "duplicate"), (2, "passed"), (3, "late"), (4, "passed"), (5, "passed"), (6, "late"),
                   (7, "passed"), (8, "no_time"), (9, "duplicate"), (10, "late"), (11, "late"), (12, "duplicate"),
                   (13, "passed")]
