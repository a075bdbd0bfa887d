import random

from pyspark.sql import functions as F

from skyfold.operators import quota as Q
from skyfold.operators.tracks import split_current_historical, track_segments


def pts(spark, recs):
    return spark.createDataFrame([("a", i, 48.0, 2.0, t, g) for i, (t, g) in enumerate(recs)],
                                 "icao24 string, event_id bigint, lat double, lon double, last_seen bigint, "
                                 "on_ground boolean")


def test_segments_golden(spark):
    df = pts(spark, [(t, None) for t in [0, 60, 1000, 1060, 5000]])
    segs = {}
    for r in track_segments(df, 900).collect():
        segs.setdefault(r.segment, []).append(r.last_seen)
    assert sorted(sorted(v) for v in segs.values()) == [[0, 60], [1000, 1060]]


def test_segments_chunked_equals_plain(spark):
    random.seed(3)
    ts = sorted(random.sample(range(0, 10 * 86400), 400))
    df = pts(spark, [(t, None) for t in ts])
    plain = sorted((r.last_seen, r.segment) for r in track_segments(df, 3600).collect())
    chunked = sorted((r.last_seen, r.segment) for r in track_segments(df, 3600, split_seconds=86400).collect())
    assert plain == chunked


def test_current_historical_split_golden(spark):
    df = pts(spark, [(0, True), (10, True), (20, False), (30, False)])
    side = {r.last_seen: r.side for r in split_current_historical(df).collect()}
    assert side == {0: "historical", 10: "historical", 20: "current", 30: "current"}


def log(spark, recs):
    return spark.createDataFrame(
        [("s", ts, i, sc, rem, lim, None, 200, 1.0, failed) for i, (ts, sc, rem, lim, failed) in enumerate(recs)],
        "source_id string, ts bigint, seq bigint, states_count int, remaining int, credit_limit int, reset_at bigint, "
        "status int, duration_ms double, failed boolean")


def test_credit_period_reset_golden(spark):
    d = Q.credit_periods(log(spark, [(1, 10, 300, 400, False), (2, 5, 350, 400, False)])).orderBy("ts").collect()
    last = d[-1]
    assert last.is_reset and last.requests_since_reset == 0 and last.credits_since_reset == 0 \
        and last.events_since_reset == 0


def test_credit_period_counts_and_chunks(spark):
    recs = [(i * 3600, 2, 400 - 4 * i, 400, False) for i in range(60)]
    plain = Q.credit_periods(log(spark, recs), split_seconds=None).orderBy("ts").collect()
    chunked = Q.credit_periods(log(spark, recs), split_seconds=86400).orderBy("ts").collect()
    assert [r.credits_since_reset for r in plain] == [r.credits_since_reset for r in chunked]
    assert plain[-1].requests_since_reset == 60 and plain[-1].credits_since_reset == 236


def test_quota_level_golden(spark):
    d = Q.quota_levels(Q.credit_periods(log(spark, [(1, 0, 399, 400, False)]))).first()
    assert d.delay_ms == 10_000
    d = Q.quota_levels(Q.credit_periods(log(spark, [(1, 0, 399, None, False)]))).first()
    assert d.delay_ms == 30_000 and d.level == "WARN_80"


def test_quota_gauges_golden(spark):
    recs = [(0, 0, 400, 400, False)] + [(i, 10, 400 - 5 * i, 400, False) for i in range(1, 11)]
    r = Q.quota_levels(Q.credit_periods(log(spark, recs))).orderBy("ts").collect()[-1]
    assert r.consumed_gauge_pct == 12.5 and r.avg_credits_per_request == 50 / 11 \
        and r.avg_events_per_request == 100 / 11


def test_failure_schedule(spark):
    d = Q.failure_streaks(log(spark, [(i, 0, None, None, True) for i in range(11)])).orderBy("ts").collect()
    assert [r.backoff_seconds for r in d[:10]] == Q.FAILURE_BACKOFF_SECONDS
    assert d[10].disabled and d[10].backoff_seconds is None
    assert [r.token_cooldown_seconds for r in d[:7]] == [15, 30, 60, 120, 300, 600, 600]


def test_fixed_window_golden(spark):
    req = spark.createDataFrame([("ip", i, 100 + i) for i in range(5)], "client string, seq bigint, ts bigint")
    acc = [r.accepted for r in Q.fixed_window_quota(req, 900, 3, hash_key=True).orderBy("seq").collect()]
    assert acc == [True, True, True, False, False]


def brute_sliding(reqs, window, mx):
    out, acc = {}, {}
    for c, s, t in sorted(reqs, key=lambda x: (x[0], x[2], x[1])):
        dq = [x for x in acc.get(c, []) if x >= t - window]
        ok = len(dq) < mx
        if ok:
            dq.append(t)
        acc[c] = dq
        out[s] = ok
    return out


def test_sliding_quota_matches_brute_force(spark):
    random.seed(7)
    reqs = [(f"c{random.randint(0, 3)}", i, random.randint(0, 2000)) for i in range(600)]
    df = spark.createDataFrame(reqs, "client string, seq bigint, ts bigint")
    got = {r.seq: r.accepted for r in Q.sliding_quota(df, window=60, max_requests=5).collect()}
    assert got == brute_sliding(reqs, 60, 5)


def test_sliding_quota_of_a_client_that_never_pauses(spark):
    """No gap exceeds the window; busy hours alternate with free ones over many
    stretches, seconds hold several requests and a client may be null."""
    random.seed(11)
    reqs, t = [], 0
    while t < 40_000:
        t += random.randint(0, 6) if (t // 1500) % 2 else random.randint(12, 40)
        reqs.append(("busy", len(reqs), t))
    reqs += [(None, len(reqs) + i, random.randint(0, 3000)) for i in range(400)]
    df = spark.createDataFrame(reqs, "client string, seq bigint, ts bigint")
    for mx in (1, 6):
        got = {r.seq: r.accepted for r in Q.sliding_quota(df, 60, mx, split_seconds=500).collect()}
        assert got == brute_sliding([(c or "", s, t) for c, s, t in reqs], 60, mx)


def test_sliding_quota_scans_contested_runs_only(spark):
    free = [("a", i, 100 * i) for i in range(50)]
    df = spark.createDataFrame(free + [("b", 100 + i, i // 4) for i in range(40)] + [("c", 900, None)],
                               "client string, seq bigint, ts bigint")
    rows = {(r.client, r.seq): r.accepted for r in Q.sliding_quota(df, 60, 10).collect()}
    assert all(rows["a", i] for i in range(50))
    assert [rows["b", 100 + i] for i in range(40)] == [True] * 10 + [False] * 30
    assert rows["c", 900] is None


def test_counter_increase_with_reset(spark):
    s = spark.createDataFrame([("m", "i", t, t, v) for t, v in [(10, 5.0), (20, 8.0), (30, 2.0), (40, 6.0)]],
                              "metric string, instance string, ts bigint, seq bigint, value double")
    assert Q.counter_increase(s, 40, 100).first()["increase"] == 3.0 + 2.0 + 4.0


def test_parse_headers(spark):
    df = spark.createDataFrame([("350", "400", "120", 1_700_000_000), ("x", "", "1699000000", 1_700_000_000)],
                               "remaining_raw string, limit_raw string, reset_raw string, fetched_at bigint")
    r = Q.parse_fetch_headers(df).collect()
    assert (r[0].remaining, r[0].credit_limit, r[0].reset_at) == (350, 400, 1_700_000_120)
    assert (r[1].remaining, r[1].credit_limit, r[1].reset_at) == (None, None, None)
    _ = F


def test_chunked_helpers_keep_null_keys(spark):
    from skyfold.operators.sequence import previous_values, running_sum, time_chunk
    df = spark.createDataFrame([(None, t, 1) for t in (0, 100, 90000, 200000)] + [("k", 5, 1)],
                               "k string, ts long, v int")
    key = lambda t: (t[0] or "", t[1])
    plain = sorted(((r.k, r.ts, r.p_ts, r.s) for r in running_sum(
        previous_values(df, ["k"], ["ts"], ["ts"], prefix="p_"), ["k"], ["ts"], F.col("v"), "s").collect()), key=key)
    ch = time_chunk("ts", 86400)
    chunked = sorted(((r.k, r.ts, r.p_ts, r.s) for r in running_sum(
        previous_values(df, ["k"], ["ts"], ["ts"], prefix="p_", chunk=ch), ["k"], ["ts"], F.col("v"), "s",
        chunk=ch).collect()), key=key)
    assert plain == chunked
    assert [r for r in chunked if r[1] == 200000][0][2:] == (90000, 4)
