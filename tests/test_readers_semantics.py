"""Payload coercion and rejects, year and epoch parsing, limits and layouts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skyfold.functions import expr as X
from skyfold.operators import observability as Ob
from skyfold.operators.latest import latest_by_last_seen
from skyfold.plans.flights import clamp_limit
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources import readers as Rd
from skyfold.sources import sinks


def routes(spark, payloads):
    df = spark.createDataFrame([(p if isinstance(p, str) or p is None else json.dumps(p),) for p in payloads], "value string")
    return Rd.route_events(Rd.read_position_events(df)).collect()


def test_payload_coercion_and_rejects(spark):
    got = routes(spark, [
        {"icao24": "abc123", "lat": "48.1", "last_contact": "7", "on_ground": "true", "callsign": 12},
        {"icao24": "abc123", "lat": "oops"}, {"icao24": "\t"}, {"icao24": "\t ABC123\n", "lat": None},
        {"icao24": "abc123", "lat": [1]}, {"icao24": "abc123", "callsign": {"a": 1}}, {"icao24": "abc123", "lat": " "},
        "[1]", "{", "", None, {"lat": 1.0}, {"icao24": "x", "callsign": "[not json"}])
    assert [r._route for r in got] == ["ok", "dead", "dead", "ok", "dead", "dead", "ok", "dead", "dead", "dead", "dead",
                                       "dead", "ok"]
    assert (got[0].lat, got[0].last_contact, got[0].on_ground, got[0].callsign) == (48.1, 7, True, "12")
    assert got[3].icao24 == "abc123" and got[3].lat is None and got[6].lat is None


def test_years_and_epochs(spark):
    df = spark.createDataFrame([("0000001999",), ("1899",), ("2100",), ("2101",), ("19x9",), ('"2001"',), ("0" * 40 + "2024",),
                                (None,)], "s string")
    assert [r[0] for r in df.select(X.to_year("s")).collect()] == [1999, None, 2100, None, None, 2001, 2024, None]
    cases = [("2024-01-01T00:00Z", 1704067200), ("2024-01-01T00:00:00.123456789Z", 1704067200), ("0001700000000", 1700000000),
             ("2024-01-01T02:00:00+02:00", 1704067200), ("2024-01-01t00:00z", 1704067200), ("1700000000123", 1700000000),
             ("9" * 20, None), ("2024-01-01", None), ("2024-01-01T00:00:00", None), (" ", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = df.select(X.epoch_or_iso_to_epoch("s").alias("t"), X.unreadable_epoch("s").alias("bad")).collect()
    assert [r.t for r in got] == [t for _, t in cases]
    assert [r.bad for r in got] == [False] * 6 + [True] * 3 + [False]
    with pytest.raises(Exception, match="not an epoch"):
        df.select(X.epoch_or_iso_to_epoch("s", strict=True)).collect()


def test_latest_by_last_seen_normalises_the_key(spark):
    df = spark.createDataFrame([(" ABC123", 1.0, 1.0, 5, 1), ("abc123", 1.0, 1.0, 9, 2), ("\t", 1.0, 1.0, 9, 3)],
                               "icao24 string, lat double, lon double, last_contact long, event_id long")
    assert [tuple(r)[:1] + (r.last_contact,) for r in latest_by_last_seen(df).collect()] == [("abc123", 9)]


def test_limit_is_rejected_not_raised():
    assert clamp_limit(None) == 200 and clamp_limit(5000) == 1000
    for bad in (0, -3):
        with pytest.raises(ValueError):
            clamp_limit(bad)


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(Session())


def test_a_busy_day_is_many_files(spark, tmpdir_path):
    n = 4000
    df = spark.range(n).select((F.col("id") % 86400).alias("last_contact"), (F.col("id") / 100).alias("lat"),
                               F.lit(1.0).alias("lon"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_positions(df, tmpdir_path + "/p")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(tmpdir_path + "/p/day=1970-01-01") if f.endswith(".parquet")]
    assert len(files) > 1 and sinks.read_positions(spark, tmpdir_path + "/p").count() == n


def alerts(spark, rows):
    df = spark.createDataFrame(rows, "metric string, instance string, outcome string, ts long, seq long, value double")
    return sorted((r.rule, r.series, r.start_ts, r.duration_s, r.fired) for r in Ob.sustained_alerts(df).collect())


def test_alert_islands_end_where_samples_end(spark):
    up = lambda t, v=0.0: ("up", "a", None, t, t, v)
    # two samples ten hours apart do not make an alert of ten hours
    assert [a[3:] for a in alerts(spark, [up(0), up(36_000)])] == [(240, False), (240, False)]
    got = alerts(spark, [up(60 * i) for i in range(15)])
    assert got == [("CriticalTargetDown", "a", 0, 60 * 14 + 240, True)]


def test_alerts_aggregate_series_first(spark):
    m = "processor_queue_depth"
    rows = [(m, "a", None, 60 * i, i, 600.0 if i % 2 else 1.0) for i in range(14)]
    rows += [(m, "b", None, 60 * i, 100 + i, 1.0 if i % 2 else 600.0) for i in range(14)]
    got = alerts(spark, rows)
    assert [(a[0], a[1], a[4]) for a in got] == [("RedisQueueBacklogHigh", "", True)]
    other = "ingester_opensky_states_http_requests_total"
    assert alerts(spark, [(other, "a", "success", 60 * i, i, float(i)) for i in range(30)]) == []
    assert alerts(spark, [("ingester_opensky_requests_since_reset", "a", None, 60 * i, i, float(i)) for i in range(30)]) == []


def test_alerts_shuffle_samples_once_and_see_across_spells(spark):
    edge, other = Ob.ALERT_SPELL_SECONDS, "ingester_opensky_states_http_requests_total"
    up = [("up", "a", None, edge + 60 * i, i, 0.0) for i in range(-5, 6)]
    # the counter grows between two samples on both sides of the edge, and is reset in between once
    grew = [(other, "a", "rate_limited", edge + t, t, v) for t, v in ((-130, 5.0), (100, 2.0), (110, 2.0))]
    assert alerts(spark, up + grew) == [("CriticalTargetDown", "a", edge - 300, 840, True),
                                        ("OpenSkyRateLimited", "", edge + 120, 0, False)]
    df = spark.createDataFrame(up, "metric string, instance string, outcome string, ts long, seq long, value double")
    plan = Ob.sustained_alerts(df)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert "collect_list" not in plan and sum("metric#" in k for k in keys) == 1
