from pyspark.sql import functions as F

from skyfold.functions import expr as X
from skyfold.functions.taxonomy import aircraft_size, airframe_type, fleet_type
from skyfold.operators.filters import Bbox, classify_bbox


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_round2_and_pct(spark):
    assert one(spark, X.round2(F.lit(33.333))) == 33.33
    assert one(spark, X.pct(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, X.pct(F.lit(1), F.lit(4))) == 25.0
    # Java Math.round semantics: 1.005*100 = 100.49999... -> 1.0 (not 1.01)
    assert one(spark, X.round2(F.lit(1.005))) == 1.0


def test_lerp_heading_shortest_arc(spark):
    assert one(spark, X.lerp_heading(F.lit(350.0), F.lit(10.0), F.lit(0.5))) == 0.0
    assert one(spark, X.lerp_heading(F.lit(None).cast("double"), F.lit(10.0), F.lit(0.5))) == 10.0
    assert one(spark, X.lerp(F.lit(None).cast("double"), F.lit(4.0), F.lit(0.5))) == 4.0


def test_haversine(spark):
    d = one(spark, X.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278)))
    assert 340 < d < 345


def test_bbox_classification_edges(spark):
    b = Bbox(1.0, 47.0, 3.0, 49.0)
    df = spark.createDataFrame([(47.0, 1.0), (49.0, 3.0), (50.0, 2.0), (None, 2.0), (48.0, None)],
                               "lat double, lon double")
    got = [r[0] for r in df.select(classify_bbox(b)).collect()]
    assert got == ["INSIDE", "INSIDE", "OUTSIDE", "UNKNOWN", "UNKNOWN"]


def test_airframe_golden(spark):
    df = spark.createDataFrame([("H2T", None), (None, "EC45"), ("Commercial", "A320"), (None, None)],
                               "cat string, tc string")
    assert [r[0] for r in df.select(airframe_type("cat", "tc")).collect()] == \
        ["helicopter", "helicopter", "airplane", None]


def test_fleet_rescue_golden(spark):
    df = spark.createDataFrame([(None, "SAMUIDF", "Commercial", "SAMU IDF")],
                               "mil boolean, cs string, cat string, own string")
    assert df.select(fleet_type("mil", "cs", "cat", "own")).first()[0] == "rescue"


def test_size_golden(spark):
    df = spark.createDataFrame([("heavy", "A380"), (None, "C172"), (None, "A220")], "cat string, tc string")
    assert [r[0] for r in df.select(aircraft_size("cat", "tc")).collect()] == ["heavy", "small", "medium"]


def test_scale_bbox_factor_below_one_is_identity(spark):
    df = spark.createDataFrame([(1.0, 47.0, 3.0, 49.0, 0.5)], "a double, b double, c double, d double, f double")
    s = X.scale_bbox("a", "b", "c", "d", "f")
    r = df.select(*[v.alias(k) for k, v in s.items()]).first()
    assert (r.min_lon, r.min_lat, r.max_lon, r.max_lat) == (1.0, 47.0, 3.0, 49.0)


def test_epoch_or_iso(spark):
    df = spark.createDataFrame([("1700000000",), ("1700000000123",), ("2023-11-14T22:13:20+00:00",)], "s string")
    assert [r[0] for r in df.select(X.epoch_or_iso_to_epoch("s")).collect()] == [1700000000] * 3


def test_typecode_and_labels(spark):
    df = spark.createDataFrame([("TOO_LONG_TYPECODE", None), (" a320 ", True), ("  ", False)],
                               "tc string, mil boolean")
    assert [r[0] for r in df.select(X.sanitize_typecode("tc")).collect()] == ["unknown", "A320", "unknown"]
    assert [r[0] for r in df.select(X.military_label("mil")).collect()] == ["unknown", "true", "false"]


def test_trim_to_null_java_semantics(spark):
    df = spark.createDataFrame([("\t x \n",), ("   ",), (None,)], "s string")
    assert [r[0] for r in df.select(X.trim_to_null("s")).collect()] == ["x", None, None]
