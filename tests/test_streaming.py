import os
import random

from pyspark.sql import functions as F

from skyfold.operators.activity import activity_buckets
from skyfold.operators.latest import build_latest
from skyfold.sources.testdata import Tables
from skyfold.streaming import streams as St

SF = "/root/testdata/sf0.001"


def split_events(spark, out_dir, reverse=False, parts=4):
    """Write the events table as ``parts`` files by time range."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    q = ev.select(F.percentile_approx(F.col("event_id"), [0.25, 0.5, 0.75]).alias("q")).first()[0]
    bounds = [-1] + list(q) + [10 ** 12]
    order = list(range(parts))[::-1] if reverse else list(range(parts))
    src = os.path.join(out_dir, "events_src")
    for n, i in enumerate(order):
        part = ev.where((F.col("event_id") > bounds[i]) & (F.col("event_id") <= bounds[i + 1]))
        part.coalesce(1).write.parquet(os.path.join(src, f"part{n}"))
        # file streams pick files by modification time; keep order explicit
    return src


def stream_latest(spark, src, tmp):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    pos = St.positions_stream(ev).where(F.col("icao24").isNotNull())
    out = os.path.join(tmp, "out")
    St.run_available_now(St.upsert_log_sink(St.stream_latest_state(pos), out, os.path.join(tmp, "ck")))
    return St.read_upsert_log(spark, out, ["icao24"]), spark.read.parquet(out).select("batch_id").distinct().count()


def test_stream_latest_equals_batch(spark, tmpdir_path):
    src = split_events(spark, tmpdir_path)
    streamed, batches = stream_latest(spark, src, tmpdir_path)
    assert batches >= 2
    batch = build_latest(Tables(spark, SF).positions)
    cols = ["icao24", "event_id", "last_contact", "prev_last_contact", "prev_lat", "prev_altitude"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b


def test_stream_out_of_order_never_moves_latest_back(spark, tmpdir_path):
    src = split_events(spark, tmpdir_path, reverse=True)
    streamed, _ = stream_latest(spark, src, tmpdir_path)
    batch = {r.icao24: r.last_contact for r in build_latest(Tables(spark, SF).positions).collect()}
    got = streamed.collect()
    assert all(r.last_contact == batch[r.icao24] for r in got)
    assert sum(r.late_events for r in got) > 0
    assert all(r.track_points <= 180 for r in got)


def test_stream_activity_counts_equal_batch(spark, tmpdir_path):
    src = split_events(spark, tmpdir_path)
    t = Tables(spark, SF)
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    pos = St.positions_stream(ev).where(F.col("icao24").isNotNull())
    out = os.path.join(tmpdir_path, "act")
    St.run_available_now(St.upsert_log_sink(St.stream_activity(St.enrich_stream(pos, t.aircraft)), out,
                                            os.path.join(tmpdir_path, "ck2")))
    streamed = {r.bucket_epoch: r.events_total for r in St.read_upsert_log(spark, out, ["bucket_epoch"]).collect()}
    from skyfold.operators.enrich import enrich_events
    batch = {r.bucket_epoch: r.events_total for r in
             activity_buckets(enrich_events(t.positions.where("icao24 is not null"), t.aircraft), 60).collect()}
    assert streamed == batch


def test_published_payload_files_round_trip_through_stream(spark, tmpdir_path):
    from skyfold.sources import readers as Rd
    t = Tables(spark, SF)
    land = os.path.join(tmpdir_path, "queue")
    pos = t.positions
    Rd.publish_events(pos.where("event_id % 2 = 0"), "2024-01-01T00:00:00Z").write.text(land + "/a")
    Rd.publish_events(pos.where("event_id % 2 = 1"), "2024-01-01T00:00:00Z").write.text(land + "/b")
    payloads = St.payload_stream(spark, "files", land + "/*", max_files=1)
    valid, dead = St.stream_positions(payloads)
    out = os.path.join(tmpdir_path, "valid")
    St.run_available_now(St.upsert_log_sink(valid.select("icao24", "last_contact", "lat"), out,
                                            os.path.join(tmpdir_path, "ck3"), output_mode="append"))
    got = spark.read.parquet(out).count()
    assert got == pos.where("icao24 is not null").count()


def test_stream_health_backlog_counts_down(spark, tmpdir_path):
    src = split_events(spark, tmpdir_path)
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    q = (ev.writeStream.format("noop").option("checkpointLocation", os.path.join(tmpdir_path, "ck_h"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    h = St.stream_health(q).where("input_rows > 0").orderBy("batch_id").collect()
    assert len(h) >= 2
    assert [r.backlog for r in h] == sorted((r.backlog for r in h), reverse=True) and h[-1].backlog == 0
    assert sum(r.input_rows for r in h) == spark.read.parquet(f"{SF}/events.parquet").count()


def _arrive(spark, tmp, batches, writer):
    """Land hand-made event rows batch by batch and run the stream over each."""
    schema = "icao24 string, event_id long, callsign string, lat double, lon double, heading double, velocity double, " \
             "geo_altitude double, baro_altitude double, on_ground boolean, last_contact long, batch_epoch long"
    for i, rows in enumerate(batches):
        full = [(k, e, None, la, lo, None, None, None, None, None, lc, b) for k, e, la, lo, lc, b in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.parquet(f"{tmp}/in/b{i}")
        St.run_available_now(writer(spark.readStream.schema(schema).parquet(f"{tmp}/in/*")))


def test_null_times_do_not_erase_state(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    _arrive(spark, tmpdir_path, [[("a", 1, 48.5, 2.0, 1000, 900), ("a", 2, None, None, None, None)],
                                 [("a", 3, 48.6, 2.1, 2000, 1800)], [("a", 4, 48.7, 2.2, 1500, 1800)]],
            lambda s: St.upsert_log_sink(St.stream_latest_state(s), out, f"{tmpdir_path}/ck"))
    r = St.read_upsert_log(spark, out, ["icao24"]).first()
    assert (r.last_contact, r.prev_last_contact, r.prev_lat, r.late_events) == (2000, 1000, 48.5, 1)
    assert [p.last_contact for p in r.track] == [2000, 1500, 1000, None]
    St.compact_upsert_log(spark, out, ["icao24"])
    assert spark.read.parquet(out).count() == 1 and St.read_upsert_log(spark, out, ["icao24"]).first() == r


def test_late_event_does_not_move_membership(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    _arrive(spark, tmpdir_path, [[("a", 1, 48.5, 2.0, 5000, 1)], [("a", 2, 10.0, 2.0, 3000, 1)]],
            lambda s: St.upsert_log_sink(St.stream_latest_state(s), out, f"{tmpdir_path}/ck"))
    r = St.read_upsert_log(spark, out, ["icao24"]).first()
    assert r.inside is True and r.late_events == 1


def test_older_epochs_emit_nothing(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    _arrive(spark, tmpdir_path, [[("a", 1, 1.0, 1.0, 1, 5000)], [("b", 2, 1.0, 1.0, 1, 3000)], [("c", 3, 1.0, 1.0, 1, None)],
                                 [("d", 4, 1.0, 1.0, 1, 6000), ("d", 5, 1.0, 1.0, 1, 100)]],
            lambda s: St.upsert_log_sink(St.stream_batch_updates(s), out, f"{tmpdir_path}/ck"))
    assert sorted(r.latest_batch_epoch for r in spark.read.parquet(out).collect()) == [5000, 6000]


def test_late_rows_go_to_the_side_table(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    _arrive(spark, tmpdir_path, [[("a", 1, 1.0, 1.0, 10_000, 1)],
                                 [("a", 2, 1.0, 1.0, 9_500, 1), ("a", 3, 1.0, 1.0, 9_000, 1), ("b", 4, 1.0, 1.0, None, 1)]],
            lambda s: St.upsert_log_sink(St.late_rows(s, 600), out, f"{tmpdir_path}/ck", output_mode="append"))
    got = sorted((r.icao24, r.event_id, r.last_contact, r.reason) for r in spark.read.parquet(out).collect())
    assert got == [("a", 3, 9_000, "late"), ("b", 4, None, "no_time")]


def _random_batches(seed, n=240, batches=3):
    """Out-of-order rows with nulls, replays and one aircraft that has half of all."""
    rnd = random.Random(seed)
    rows = []
    for e in range(n):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(6)}"
        lat = None if rnd.random() < 0.2 else rnd.choice([48.5, 10.0])
        rows.append((key, e, lat, 2.0, None if rnd.random() < 0.1 else rnd.randrange(1000, 1060),
                     None if rnd.random() < 0.1 else rnd.randrange(3)))
    rows += rnd.sample(rows, 20)
    rnd.shuffle(rows)
    return [rows[i::batches] for i in range(batches)]


def test_reduced_state_equals_row_by_row_state(spark, tmpdir_path):
    batches = _random_batches(5)
    one, two = os.path.join(tmpdir_path, "one"), os.path.join(tmpdir_path, "two")
    _arrive(spark, one, batches, lambda s: St.upsert_log_sink(St.stream_latest_state(s), one + "/out", one + "/ck"))
    _arrive(spark, two, batches, lambda s: St.upsert_log_sink(St.stream_latest(s), two + "/out", two + "/ck"))
    cols = ["icao24", "batch_id", "event_id", "last_contact", "batch_epoch", "prev_lat", "prev_last_contact", "inside",
            "late_events", "track_points"]
    a = {tuple(r) for r in spark.read.parquet(one + "/out").select(*cols).collect()}
    b = {tuple(r) for r in spark.read.parquet(two + "/out").select(*cols).collect()}
    assert a == b and len(a) > 10


def test_track_log_keeps_the_newest_points(spark, tmpdir_path):
    batches, out = _random_batches(6), os.path.join(tmpdir_path, "out")
    _arrive(spark, tmpdir_path, batches, lambda s: St.track_log_writer(s, out, f"{tmpdir_path}/ck", n=15))

    def order(r):  # nulls first
        return tuple((v is not None, v or 0) for v in (r[4], r[5], r[1]))

    want = set()
    rows = [r for b in batches for r in b]
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=order, reverse=True)[:15]
        want |= {(key, i + 1, r[1]) for i, r in enumerate(own)}
    got = lambda: {(r.icao24, r.rank, r.event_id) for r in St.read_track_log(spark, out, 15).collect()}
    assert got() == want
    # a micro-batch hands on at most 15 points of the aircraft with half of all rows
    assert spark.read.parquet(out).where("icao24 = 'hot'").groupBy("batch_id").count().agg(F.max("count")).first()[0] == 15
    St.compact_track_log(spark, out, 15)
    assert got() == want and spark.read.parquet(out).count() == len(want)
