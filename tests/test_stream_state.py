"""State that streams keep in files beside their checkpoint."""

import os

from skyfold.streaming import routing as R
from skyfold.streaming import streams as St


def test_routes_need_no_call_per_aircraft(spark, tmpdir_path):
    schema = "icao24 string, event_id long, last_contact long"
    rows = [("a", 9, 1000), ("a", 3, 1000), (None, 4, 1000), (None, 5, 1000), ("a", 6, None), ("a", 6, None), ("a", 7, 399),
            ("b", 8, 700), ("b", 10, -5)]
    held = spark.createDataFrame([("b", 700), (None, 2000)], "icao24 string, last_contact long")
    d = R.routed(spark.createDataFrame(rows, schema), 400, held)
    assert sorted((r.event_id, r.route) for r in d.collect()) == [
        (3, "passed"), (4, "passed"), (5, "duplicate"), (6, "no_time"), (6, "no_time"), (7, "late"), (8, "duplicate"),
        (9, "duplicate"), (10, "late")]
    plan = d._jdf.queryExecution().toString()
    assert "Python" not in plan and "TransformWithState" not in plan
    # the state of a stream: two micro-batches, pairs that can still be repeated
    for i, newest in enumerate([1000, 5000, 9000]):
        spark.createDataFrame([("a", 2 * i, newest), ("b", 2 * i + 1, newest - 700)], schema).write.parquet(
            f"{tmpdir_path}/in/b{i}")
        src = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in/*")
        St.run_available_now(R.routed_sink(R.route_events(src, 600), f"{tmpdir_path}/out", f"{tmpdir_path}/ck"))
    assert sorted(os.listdir(f"{tmpdir_path}/ck/held")) == ["000000000001", "000000000002"]
    left = spark.read.parquet(f"{tmpdir_path}/ck/held/000000000002/pairs").collect()
    assert [tuple(r) for r in left] == [("a", 9000)]
    assert spark.read.parquet(f"{tmpdir_path}/out").where("route = 'passed'").count() == 6


def test_latest_state_needs_no_call_per_aircraft(spark, tmpdir_path):
    """One row per changed aircraft and micro-batch, by Spark's own operators; the
    state survives new bases, and a replay of a micro-batch writes the same rows."""
    schema = "icao24 string, event_id long, callsign string, lat double, lon double, heading double, velocity double, " \
             "geo_altitude double, baro_altitude double, on_ground boolean, last_contact long, batch_epoch long"
    row = lambda k, e, t, lat=48.5: (k, e, None, lat, 2.0, None, None, None, 7.0, None, t, 1)
    batches = [[row("a", 1, 50), row("a", 2, 40), row(None, 3, 10)], [row("a", 4, 45), row("b", 5, 1, float("nan"))],
               [row(None, 6, 5, 10.0), row("a", 7, 60, 10.0)], [row("b", 8, None)], [row("a", 9, 55), row(None, 10, 10)]]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    step = St.stream_latest(frames[0]).step
    log = St.StateLog(spark, f"{tmpdir_path}/state", ["icao24"], span=2)
    cols = ["icao24", "event_id", "prev_last_contact", "prev_altitude", "inside", "late_events", "track_points"]
    for i, frame in enumerate(frames):
        changed = step(frame, log.before(i))
        plan = changed._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan
        once = sorted(map(str, log.write(changed, i).collect()))
        assert once == sorted(map(str, log.write(step(frame, log.before(i)), i).collect()))
    got = {tuple(r) for r in log.before(len(frames)).select(*cols).collect()}
    assert got == {("a", 7, 50, 7.0, False, 2, 5), ("b", 5, None, None, True, 1, 2), (None, 10, 10, 7.0, True, 1, 3)}
    assert sorted(os.listdir(f"{tmpdir_path}/state/base")) == ["000000000001", "000000000003"]
