"""Property checks: chunked == plain with nulls, segment count
≤ points, series sums preserved, dedup idempotent."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfold.operators import quota as Q
from skyfold.operators.activity import activity_series
from skyfold.operators.latest import latest_per_aircraft
from skyfold.operators.tracks import track_segments
from tests.test_latest import pos
from tests.test_tracks_quota import log, pts


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_credit_periods_chunked_with_null_remaining(spark, seed):
    rnd = random.Random(seed)
    recs = [(i * 7200 + rnd.randint(0, 100), rnd.randint(0, 9),
             None if rnd.random() < 0.3 else rnd.randint(0, 400), 400, rnd.random() < 0.1) for i in range(80)]
    cols = ["ts", "last_known_remaining", "is_reset", "period", "requests_since_reset", "credits_since_reset"]
    a = [tuple(r) for r in Q.credit_periods(log(spark, recs), split_seconds=None).orderBy("ts").select(*cols).collect()]
    b = [tuple(r) for r in Q.credit_periods(log(spark, recs), split_seconds=86400).orderBy("ts").select(*cols).collect()]
    assert a == b


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50_000), min_size=1, max_size=60, unique=True))
def test_segments_never_exceed_points(spark, times):
    df = pts(spark, [(t, None) for t in times])
    segs = track_segments(df, 900)
    n_seg = segs.select("segment").distinct().count()
    assert n_seg <= len(times) // 2
    assert all(r.segment_points >= 2 for r in segs.collect())


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=59), st.integers(min_value=1, max_value=9)),
                min_size=1, max_size=30, unique_by=lambda x: x[0]))
def test_series_preserves_sums(spark, mins):
    now = 1_700_003_600
    start = now - 3600
    recs = [((start // 60 + 1 + m) * 60, c, 0, 1, 0) for m, c in mins]
    df = spark.createDataFrame(recs, "bucket_epoch bigint, events_total bigint, events_military bigint, "
                                     "aircraft_total bigint, aircraft_military bigint")
    s = activity_series(df, now, 3600, 12).agg(F.sum("events_total")).first()[0]
    assert s == sum(c for _, c in mins)


def test_latest_is_idempotent(spark):
    df = pos(spark, [dict(icao24=f"a{i % 5}", last_contact=i, batch_epoch=i // 4) for i in range(40)])
    once = latest_per_aircraft(df)
    twice = latest_per_aircraft(once)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())
