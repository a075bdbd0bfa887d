import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "icao24" in df.columns


def test_every_batch_query_runs_and_has_oracle_names(spark):
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    for name, fn in qs.items():
        if name.startswith("t") and "stream" in name:
            continue
        df = fn(spark, SF)
        df.limit(1).collect()
