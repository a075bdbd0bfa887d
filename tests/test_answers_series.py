"""Sketch tables, chained windows, the track layout and the whole metrics answer."""

import glob
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from skyfold.operators.activity import activity_buckets, sketch_estimates, unite_buckets
from skyfold.plans.flights import flight_detail
from skyfold.plans.metrics import MetricsResult, metrics_answer
from skyfold.schemas import AIRCRAFT, POSITIONS
from skyfold.sources.sinks import write_tracks
from skyfold.streaming import streams as St

EVENTS = "icao24 string, last_contact long, military_hint boolean"


def test_united_sketches_count_an_aircraft_once(spark):
    history = spark.createDataFrame([("a", 0, True), ("b", 30, False), ("c", 70, None)], EVENTS)
    stream = spark.createDataFrame([("a", 10, True), ("d", 59, True), ("c", 130, False)], EVENTS)
    sketch = lambda df: activity_buckets(df, 60, mode="sketch")
    empty = sketch(history.limit(0))
    got = sketch_estimates(unite_buckets(sketch(history), sketch(stream), empty)).orderBy("bucket_epoch").collect()
    assert [tuple(r) for r in got] == [(0, 4, 3, 3, 2), (60, 1, 0, 1, 0), (120, 1, 0, 1, 0)]


def test_chained_windows_emit_a_display_bucket_once(spark, tmpdir_path):
    """Display 300 s, delay 100 s.  A report of a closed minute is left out, one of a
    minute still open in an old display bucket is not; reports without a time are ignored."""
    batches = [[("a", 10, True), ("b", 70, False), (None, None, None)],
               [("a", 290, True), ("c", 20, False)],    # watermark before this batch: -30
               [("a", 450, False), ("d", 30, True)],    # before: 190, so minute 0 has closed; after: 350
               [("e", 1000, False), ("f", 299, True)]]  # before: 350; after: 900
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmpdir_path}/in/b{i}")
        src = spark.readStream.schema(spark.createDataFrame([], EVENTS).schema).parquet(f"{tmpdir_path}/in/*")
        St.run_available_now(St.upsert_log_sink(St.stream_activity_series(src, 300, 60, 100), tmpdir_path + "/out",
                                                tmpdir_path + "/ckpt", output_mode="append"))
    got = spark.read.parquet(tmpdir_path + "/out").drop("batch_id").orderBy("bucket_start").collect()
    assert [tuple(r) for r in got] == [(0, 4, 2, 3, 1, 3), (300, 1, 0, 1, 0, 1)]


def test_a_point_lookup_reads_few_row_groups(spark, tmpdir_path):
    """400 aircraft, one of them with a third of all rows."""
    n = 120_000
    pos = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "00ffff").otherwise(F.format_string("%06x", F.col("id") % 400)).alias("icao24"),
        (F.col("id") * 7919 % n).alias("last_contact"), F.col("id").alias("event_id"))
    cols = [F.col(f.name) if f.name in pos.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in POSITIONS.fields]
    write_tracks(pos.select(*cols, *[c for c in ("event_id",) if c not in POSITIONS.names]), tmpdir_path + "/t", 1 << 14)
    groups = held = 0
    for name in glob.glob(tmpdir_path + "/t/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = [meta.schema.column(i).path for i in range(meta.num_columns)].index("icao24")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups, held = groups + 1, held + (s.min <= "00007b" <= s.max)
    assert groups > 40 and held / groups < 0.05
    tracks = spark.read.parquet(tmpdir_path + "/t")
    latest = tracks.groupBy("icao24").agg(F.max_by(F.struct(*[c for c in tracks.columns if c != "icao24"]),
                                                   "last_contact").alias("r")).select("icao24", "r.*")
    d = flight_detail(latest, spark.createDataFrame([], AIRCRAFT), tracks, " 00007B ", track_points=10)
    assert "EqualTo(icao24,00007b)" in d._jdf.queryExecution().executedPlan().toString()
    row = d.first()
    times = [r.last_contact for r in tracks.where("icao24 = '00007b'").orderBy(F.desc("last_contact")).limit(10).collect()]
    assert [p.last_contact for p in row.track] == times
    assert flight_detail(latest, spark.createDataFrame([], AIRCRAFT), tracks, None).count() == 0


def test_metrics_answer_has_every_field_on_empty_input(spark):
    k = spark.createDataFrame([(0, 0.0)], "active_aircraft long, traffic_density double")
    item = spark.createDataFrame([("b", 1, 50.0, 1), ("a", 1, 50.0, 0)], "key string, count long, percent double, ordinal int")
    none = spark.createDataFrame([], "key string, count long, percent double")
    series = spark.createDataFrame([], "idx long, bucket_start long, events_total long, events_military long, "
                                       "aircraft_total long, aircraft_military long, military_share_pct double, has_data boolean")
    a = json.loads(metrics_answer(MetricsResult(k, item, item, none, series), None, "2026-01-01T00:00:00Z")
                   .select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])
    assert [x["key"] for x in a["fleet_breakdown"]] == ["a", "b"] and a["aircraft_types"] == [] == a["activity_series"]
    assert a["opensky_credits_per_request_24h"] is None and a["generated_at"] == "2026-01-01T00:00:00Z"
    assert a["estimates"]["noise_proxy_index"] is None and set(a["estimates"]["notes"]) == {
        "takeoffsLandings", "noiseProxyIndex", "alerts"}
    credits = spark.createDataFrame([("z", 3.0), ("i", 1.256)], "instance string, credits_per_request_24h double")
    assert metrics_answer(MetricsResult(k, item, item, none, series), credits).first()[
        "opensky_credits_per_request_24h"] == 1.26
