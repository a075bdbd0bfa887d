from pyspark.sql import functions as F

from skyfold.operators.activity import activity_buckets, activity_series, impute_gaps
from skyfold.operators.metrics import breakdown, exact_median


def minutes(spark, recs):
    return spark.createDataFrame(recs, "bucket_epoch bigint, events_total bigint, events_military bigint, "
                                       "aircraft_total bigint, aircraft_military bigint")


def test_series_golden_30m(spark):
    now = 1_700_000_000 - (1_700_000_000 % 60) + 30          # not on a minute boundary
    window, n = 1800, 12
    start, width = now - window, 150
    m1 = start - (start % 60) + 60 * 3                        # same display bucket
    m2 = m1 + 60
    m3 = start + width * 5 + 30
    df = minutes(spark, [(m1, 5, 2, 4, 1), (m2, 3, 1, 2, 1), (m3 - m3 % 60, 4, 1, 3, 1)])
    s = activity_series(df, now, window, n).orderBy("idx").collect()
    assert len(s) == 12
    hit = [(r.events_total, r.events_military, r.aircraft_total, r.aircraft_military, r.military_share_pct, r.has_data)
           for r in s if r.has_data]
    assert (8, 3, 6, 2, 33.33, True) in hit and (4, 1, 3, 1, 33.33, True) in hit


def test_series_empty_has_twelve_zero_buckets(spark):
    s = activity_series(minutes(spark, []), 1_700_000_000, 1800, 12).collect()
    assert len(s) == 12 and all(r.events_total == 0 and not r.has_data for r in s)


def test_impute_gaps_golden(spark):
    df = spark.createDataFrame([(0, 10, True), (1, 13, True), (2, 0, False)], "idx int, c bigint, has_data boolean")
    r = {x.idx: (x.filled, x.imputed) for x in impute_gaps(df, "c").collect()}
    assert r[2] == (12, True) and r[0] == (10, False)


def test_activity_bucket_counts(spark):
    ev = spark.createDataFrame([("abc123", 1706000001, None), ("abc123", 1706000011, True)],
                               "icao24 string, last_contact bigint, military_hint boolean")
    r = activity_buckets(ev, 60).first()
    assert r.events_total == 2 and r.aircraft_total == 1 and r.events_military == 1


def test_breakdown_canonical_order(spark):
    snap = spark.createDataFrame([("military",), ("unknown",)], "fleet string")
    got = {r["key"]: (r["count"], r["percent"]) for r in breakdown(snap, F.col("fleet"),
                                                          ["commercial", "military", "rescue", "private", "unknown"]).collect()}
    assert got["military"] == (1, 50.0) and got["unknown"] == (1, 50.0) and got["commercial"] == (0, 0.0)


def test_exact_median_even_and_odd(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 3, 10]], "v long")
    assert exact_median(df, F.col("v")).first()[0] == 4.0
    df = spark.createDataFrame([(v,) for v in [5, 1, 3]], "v long")
    assert exact_median(df, F.col("v")).first()[0] == 3.0


def test_series_merge_mode_counts_true_uniques(spark):
    # the same aircraft in two minutes of one display bucket: sum mode counts 2, merge mode 1
    ev = spark.createDataFrame([("abc123", 1_700_000_040, False), ("abc123", 1_700_000_100, False),
                                ("def456", 1_700_000_100, True)],
                               "icao24 string, last_contact bigint, military_hint boolean")
    now = 1_700_000_130          # both minutes fall in display bucket 11 (width 150 s)
    summed = activity_series(activity_buckets(ev, 60), now, 1800, 12).where("has_data").collect()
    merged = activity_series(activity_buckets(ev, 60, mode="sketch"), now, 1800, 12, distinct="merge") \
        .where("has_data").collect()
    assert sum(r.aircraft_total for r in summed) == 3
    assert sum(r.aircraft_total for r in merged) == 2 and sum(r.aircraft_military for r in merged) == 1
