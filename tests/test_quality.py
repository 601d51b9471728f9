import datetime as dt

from urbanlens.operators import quality as Q


def test_unique_accepted_relationships(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), (None, None)], "k string, c string")
    assert [(r.k, r.n_records) for r in Q.unique(df, "k").collect()] == [("a", 2)]
    assert sorted(r.c for r in Q.accepted_values(df, "c", ["x"]).collect()) == ["y", "z"]
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r.k for r in Q.relationships(child, "k", parent, "k").collect()] == ["b"]


def test_day_over_day_uses_previous_present_day(spark):
    rows = [(20240101, 100, None), (20240102, 40, None), (20240105, None, 10), (20240106, 9, 0)]
    df = spark.createDataFrame(rows, "date_key int, total_delay_incidents long, total_bike_trips long")
    got = [(r.date_key, r.previous_day_count) for r in Q.day_over_day_drops(df).orderBy("date_key").collect()]
    assert got == [(20240102, 100), (20240105, 40)]


def test_mapping_coverage_unknown_counts_as_mapped_unless_listed(spark):
    rows = [("subway", "KING")] * 98 + [("subway", "Unknown"), ("subway", None), ("bus", None)]
    df = spark.createDataFrame(rows, "transit_mode string, canonical_station_name string")
    assert Q.mapping_coverage(df).count() == 0
    r = Q.mapping_coverage(df, treat_as_unmapped=["Unknown"]).first()
    assert (r.total_rows, r.mapped_rows) == (100, 98)


def test_freshness_and_suite(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    assert Q.freshness(df, "ts", dt.date(2024, 3, 1)).first().status == "warn"
    assert Q.freshness(df, "ts", dt.date(2024, 5, 1)).first().status == "error"
    bad = spark.createDataFrame([(1,)], "x int")
    res = {r.test_name: r.status for r in Q.run_suite([Q.Check("a", "warn", bad), Q.Check("b", "error", bad),
                                                       Q.Check("c", "error", bad.limit(0))]).collect()}
    assert res == {"a": "warn", "b": "fail", "c": "pass"}


def test_volume_anomaly_passes_until_trained(spark):
    rows = [(i, 10.0 + (i % 2)) for i in range(20)] + [(20, 100.0)]
    df = spark.createDataFrame(rows, "t int, v double")
    got = [r.t for r in Q.volume_anomalies(df, "t", "v", training=14).collect()]
    assert got == [20]
    assert Q.volume_anomalies(df.filter("t < 10"), "t", "v", training=14).count() == 0


def test_reference_and_mapping_checks(spark):
    ref = spark.createDataFrame([(1, "a"), (1, "b"), (2, " ")], "id int, name string")
    got = sorted((r.check, r.detail) for r in Q.reference_records(ref, "id", ["name"]).collect())
    assert got == [("blank_name", "2"), ("duplicate_id", "1")]
    mapping = spark.createDataFrame([("K STN", "ST_001"), ("K", "ST_001"), ("X", "ST_000")],
                                    "raw_station_name string, station_key string")
    reg = spark.createDataFrame([("ST_001",), ("ST_002",)], "station_key string")
    occ = spark.createDataFrame([("K STN", 3), ("K", 1), ("X", 4)], "raw_station_name string, total_occurrences long")
    got = {(r.check, r.detail) for r in Q.mapping_checks(mapping, reg, occ).collect()}
    assert got == {("station_without_variant", "ST_002"), ("coverage_pct", "50.0")}


def test_failing_rows_and_fail_fast(spark):
    import pytest

    from urbanlens.operators import quality as Q

    good, bad = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,), (2,)], "a int")
    checks = [Q.Check("fine", "error", good), Q.Check("odd", "warn", bad), Q.Check("wrong", "error", bad)]
    assert sorted(tuple(r) for r in Q.failing_rows(checks).collect()) == [
        (n, s, f'{{"a":{i}}}') for n, s in (("odd", "warn"), ("wrong", "error")) for i in (1, 2)]
    Q.fail_fast(checks[:2])
    with pytest.raises(Q.CheckFailed, match="wrong"):
        Q.fail_fast(checks)


def test_seed_coverage(spark):
    from urbanlens import config as C
    from urbanlens.operators import quality as Q

    mapping = spark.createDataFrame([("ST_000",), ("ST_001",), ("ST_001",)], "station_key string")
    codes = spark.createDataFrame([(c, c) for c in C.DELAY_CATEGORIES[1:]], "delay_code string, delay_category string")
    got = {(r.check, r.detail) for r in Q.seed_coverage(mapping, codes, 2, 7).collect()}
    assert got == {("station_keys", "1"), ("unused_category", C.DELAY_CATEGORIES[0])}
