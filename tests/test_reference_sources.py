import os

import pytest
from pyspark.sql import functions as F

from skyfold.operators.photos import parse_photo_payloads
from skyfold.sources import readers as Rd
from skyfold.sources import reference_data as R


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_file_reader_quotes_and_last_row_wins(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "aircraft.csv")
    write(p, "icao24,country,categoryDescription,icaoAircraftClass,manufacturerIcao,manufacturerName,model,"
             "registration,typecode\n"
             "ABC123,France,'Large, wide',L2J,AIB,Airbus,A320,F-OLD,A320\n"
             " ,France,x,L2J,AIB,Airbus,A320,F-SKIP,A320\n"
             "abc123,France,'O''Neil',L2J,AIB,  ,A321,F-NEW,A321\n")
    rows = R.normalise_csv(R.read_aircraft_csv(spark, p))
    assert rows.where("_skipped").count() == 1
    last = R.last_row_per_key(rows.where(~F.col("_skipped")).drop("_skipped"), "icao24").collect()
    assert len(last) == 1 and last[0].registration == "F-NEW" and last[0].category_description == "O'Neil" \
        and last[0].manufacturer_name is None


def test_csv_missing_columns_raises(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    write(p, "icao24,country\nabc123,France\n")
    with pytest.raises(R.MissingColumnsError):
        R.read_aircraft_csv(spark, p)


def test_merge_fill_blank_and_supplement_wins(spark):
    csv = spark.createDataFrame([(0, "abc123,FR,Heavy,,,,,,A320"), (1, "def456,FR,Heavy,,,,M1,,B744")],
                                "line_no long, line string")
    sup = spark.createDataFrame([(0, '{"icao":"abc123","model":"X","mil":1,"year":"2001","ownop":"Air X"}'),
                                 (1, '{"icao":"DEF456","model":"Y","mil":"no"}'),
                                 (2, '{"icao":"0a0b0c","reg":"N1","mil":true}'),
                                 (3, 'not json'), (4, '{"icao":"zz"}')], "line_no long, line string")
    table, stats = R.build_aircraft_reference(R.parse_aircraft_csv_lines(csv), sup)
    t = {r.icao24: r for r in table.collect()}
    assert t["abc123"].model == "X" and t["abc123"].military_hint is True and t["abc123"].year_built == 2001
    assert t["def456"].model == "M1" and t["def456"].military_hint is False
    assert t["0a0b0c"].registration == "N1" and t["0a0b0c"].country is None
    s = stats.first()
    assert (s.basic_imported, s.basic_skipped_json, s.basic_skipped_icao) == (3, 1, 1)
    assert (s.rows_before, s.rows_after, s.rows_added, s.overlap_before) == (2, 3, 1, 2)


def test_versioned_write_and_optional_columns(spark, tmpdir_path):
    minimal = spark.createDataFrame([("abc123", "FR", "A3", "L2J", "AIB", "Airbus", "A320", "F-TEST", "A320")],
                                    ", ".join(f"{c} string" for c in R.AIRCRAFT_REQUIRED))
    minimal.write.parquet(os.path.join(tmpdir_path, "v1"))
    loaded = R.load_aircraft_reference(spark, os.path.join(tmpdir_path, "v1")).first()
    assert loaded.military_hint is None and loaded.year_built is None and loaded.owner_operator is None
    table = R.load_aircraft_reference(spark, os.path.join(tmpdir_path, "v1"))
    stats = spark.createDataFrame([(1,)], "rows_after long")
    target = R.write_aircraft_reference(table, stats, os.path.join(tmpdir_path, "ref"), "2024-01-01")
    assert spark.read.parquet(target + "/aircraft").count() == 1


def test_state_response_golden(spark):
    body = ('{"states":[["0d1e2f","\\tKLM77 \\n",null,1650000003,1650000009,4.75,52.25,2400.5,'
            'true,61.25,33.5,null,null,2512.0], "junk"]}')
    df = spark.createDataFrame([(body, 1650000020), ('{"states": 5}', 1), ("{oops", 2)], "body string, fetched_at long")
    states, errors = Rd.read_state_responses(df)
    ev = Rd.to_events(states).collect()
    assert len(ev) == 1 and errors.count() == 1
    e = ev[0]
    assert (e.icao24, e.callsign, e.lat, e.lon, e.velocity, e.heading, e.geo_altitude, e.baro_altitude,
            e.on_ground, e.time_position, e.last_contact, e.batch_epoch) == \
        ("0d1e2f", "KLM77", 52.25, 4.75, 61.25, 33.5, 2512.0, 2400.5, True, 1650000003, 1650000009, 1650000020)


def test_publish_then_read_round_trip(spark):
    df = spark.createDataFrame([("abc123", 1.5, 10, 5)], "icao24 string, lat double, last_contact long, batch_epoch long")
    from skyfold.schemas import POSITION_FIELDS
    for n, t in POSITION_FIELDS:
        if n not in df.columns:
            df = df.withColumn(n, F.lit(None).cast(t))
    payload = Rd.publish_events(df, "2024-01-01T00:00:00Z")
    valid, dead = Rd.split_events(Rd.read_position_events(payload))
    r = valid.first()
    assert dead.count() == 0 and (r.icao24, r.lat, r.batch_epoch, r.ingested_at) == ("abc123", 1.5, 5, "2024-01-01T00:00:00Z")


def test_dead_letters(spark):
    df = spark.createDataFrame([('{"icao24": "  "}',), ("{bad",), ('{"icao24": null}',), ('{"icao24":"AbC123 "}',)],
                               "value string")
    valid, dead = Rd.split_events(Rd.read_position_events(df))
    assert dead.count() == 3 and valid.first().icao24 == "abc123"


def test_photo_payload_cases(spark):
    good = ('{"photos":[{"thumbnail":{"src":"https://t.plnspttrs.net/a.jpg","size":{"width":200,"height":133}},'
            '"thumbnail_large":{"src":"https://t.plnspttrs.net/b.jpg","size":{"width":"420","height":280}},'
            '"link":"https://www.planespotters.net/photo/1","photographer":" Jo "}]}')
    bad_host = good.replace("https://t.plnspttrs.net/a.jpg", "https://evil.example.com/a.jpg")
    df = spark.createDataFrame([(200, good), (200, '{"photos":[]}'), (200, bad_host), (429, good), (200, '{"error":"x"}')],
                               "http_status int, body string")
    r = parse_photo_payloads(df).collect()
    assert [x.status for x in r] == ["available", "not_found", "error", "rate_limited", "error"]
    assert (r[0].thumbnail_width, r[0].large_width, r[0].large_height, r[0].photographer) == (200, None, 280, "Jo")


def test_position_layout_prunes_days(spark, tmpdir_path):
    from skyfold.sources import sinks
    from skyfold.sources.testdata import Tables
    p = Tables(spark, "/root/testdata/sf0.001").positions
    path = os.path.join(tmpdir_path, "positions")
    sinks.write_positions(p, path)
    since = p.agg(F.max("last_contact")).first()[0] - 86400
    back = sinks.read_positions(spark, path, since=since)
    assert back.count() == p.where(F.col("last_contact") >= since).count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_csv_import_limit(spark):
    lines = spark.createDataFrame([(i, f"{k},FR,x,,,,,,") for i, k in
                                   enumerate(["a00001", " ", "a00002", "a00003", " ", "a00004"])],
                                  "line_no long, line string")
    rows = R.apply_import_limit(R.normalise_csv(R.parse_aircraft_csv_lines(lines)), 2).collect()
    assert sorted(r.icao24 for r in rows if not r._skipped) == ["a00001", "a00002"]
    assert sum(1 for r in rows if r._skipped) == 1


def test_resolve_photo_falls_back_to_registration_and_ttl(spark):
    from skyfold.operators.enrich import fresh_photos, resolve_photo
    from skyfold.operators.photos import as_photo_struct
    ok = ('{"photos":[{"thumbnail":{"src":"https://t.plnspttrs.net/a.jpg"},'
          '"thumbnail_large":{"src":"https://t.plnspttrs.net/b.jpg"},"link":"https://planespotters.net/p/1"}]}')
    pay = spark.createDataFrame([("hex", "abc123", 404, "", 100), ("reg", "f-test", 200, ok, 100),
                                 ("hex", "def456", 404, "", 100)],
                                "lookup_kind string, lookup_key string, http_status int, body string, fetched_at long")
    aircraft = spark.createDataFrame([("abc123", " F-TEST "), ("def456", "  ")], "icao24 string, registration string")
    p = as_photo_struct(parse_photo_payloads(pay))
    res = {r.icao24: (r.resolved_by, r.photo.status) for r in
           resolve_photo(p.where("lookup_kind = 'hex'"), p.where("lookup_kind = 'reg'"), aircraft).collect()}
    assert res == {"abc123": ("reg", "available"), "def456": ("hex", "not_found")}
    parsed = parse_photo_payloads(pay)
    fresh = {r.lookup_key for r in fresh_photos(parsed, now=100 + 6 * 3600 - 1).collect()}
    assert fresh == {"abc123", "def456", "f-test"}
    fresh = {r.lookup_key for r in fresh_photos(parsed, now=100 + 6 * 3600).collect()}
    assert fresh == {"f-test"}


def test_lines_of_one_file_are_parsed_by_many_tasks_and_once(spark):
    sup = spark.createDataFrame([(i, f'{{"icao":"{i:06x}","reg":"R{i}","mil":1}}') for i in range(64)] + [(64, "{no")],
                                "line_no long, line string").coalesce(1)
    csv = spark.createDataFrame([(i, f"{2 * i:06x}," + ",".join("x" * 8)) for i in range(64)],
                                "line_no long, line string").coalesce(1)
    for parsed in (R.parse_supplement(sup), R.parse_aircraft_csv_lines(csv)):
        assert parsed.groupBy(F.spark_partition_id()).count().count() > 1
    plain = R.build_aircraft_reference(R.parse_aircraft_csv_lines(csv), sup)
    kept = R.build_aircraft_reference(R.parse_aircraft_csv_lines(csv), sup, keep=True)
    for a, b in zip(plain, kept):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        plan = b._jdf.queryExecution().toString()
        assert "parse_json" not in plan and "from_csv" not in plan
    assert kept[0].count() == 96
