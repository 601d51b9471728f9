import pytest
from pyspark.sql import functions as F

from urbanlens.functions.geo import haversine_km
from urbanlens.operators import geo as G
from urbanlens.operators import upsert as U


def test_haversine(spark):
    df = spark.createDataFrame([(43.65, -79.38, 43.65, -79.38), (43.0, -79.0, 44.0, -79.0)],
                               "a double, b double, c double, d double")
    d = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert d[0] == 0.0 and d[1] == pytest.approx(111.19, abs=0.01)


def test_nearest_excludes_self_and_null_coords(spark):
    st = spark.createDataFrame([("o", 43.65, -79.38), ("a", 43.66, -79.38), ("b", 43.70, -79.38),
                                ("c", None, None), ("d", 43.651, -79.38)],
                               "station_key string, latitude double, longitude double")
    got = [(r.rank, r.station_key) for r in G.nearest(st, "o", 2).collect()]
    assert got == [(1, "d"), (2, "a")]
    w = {r.station_key: r.weight for r in G.nearby_weight(G.nearest(st, "o", 3)).collect()}
    assert w["b"] == 60.0 and w["d"] > 79


def test_minmax_constant_is_midpoint(spark):
    df = spark.createDataFrame([(5,), (5,)], "v int")
    assert {r.radius for r in G.minmax_scale(df, "v").collect()} == {275.0}


def test_upsert_idempotent_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("b", 21), ("c", 30), (None, 40)], "k string, v int")
    once = U.merge_upsert(target, source, ["k"])
    twice = U.merge_upsert(once, source, ["k"])
    rows = sorted(once.collect(), key=str)
    assert rows == sorted(twice.collect(), key=str)
    assert {(r.k, r.v) for r in rows} == {("a", 1), ("b", 20), ("c", 30), (None, 40)}
    parity = U.merge_upsert(target, source, ["k"], null_safe=False)
    assert sorted(r.v for r in parity.filter(F.col("k").isNull()).collect()) == [3, 40]
    s = U.merge_stats(target, source, ["k"]).first()
    assert (s.inserted, s.updated) == (1, 2)


def test_manifest(spark):
    prev = spark.createDataFrame([("p1", 10), ("p2", 20), ("gone", 5)], "path string, size_bytes long")
    cur = spark.createDataFrame([("p1", 10), ("p2", 21), ("p3", 7)], "path string, size_bytes long")
    assert sorted(r.path for r in U.manifest_changes(prev, cur).collect()) == ["p2", "p3"]
    assert sorted((r.path, r.size_bytes) for r in U.manifest_update(prev, cur).collect()) == \
        [("p1", 10), ("p2", 21), ("p3", 7)]


def test_streaming_load_is_an_idempotent_upsert(spark, tmp_dir):
    from urbanlens.streaming import incremental as ST

    def load():
        return ST.load_incrementally(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/ck", ["k", "v"])

    def state():
        return {(r.k, r.v) for r in ST.read_current(spark, f"{tmp_dir}/t", ["k"]).collect()}

    df = spark.createDataFrame([(str(i % 7), str(i)) for i in range(40)], "k string, v string")
    ST.land_in_batches(df, f"{tmp_dir}/landing", "v", 3)
    assert load() >= 1
    expect = {(str(k), str(min((i for i in range(40) if i % 7 == k), key=str))) for k in range(7)}
    assert state() == expect
    # the same rows again, and a compaction, leave the same table
    ST.land_in_batches(df, f"{tmp_dir}/landing/again", "v", 1)
    load()
    ST.compact(spark, f"{tmp_dir}/t", ["k"])
    assert state() == expect
    # a correction takes effect, although its value is larger; before and after a compaction
    ST.land_in_batches(spark.createDataFrame([("3", "900")], "k string, v string"), f"{tmp_dir}/landing/fix", "v", 1)
    load()
    corrected = {(k, "900" if k == "3" else v) for k, v in expect}
    assert state() == corrected
    ST.compact(spark, f"{tmp_dir}/t", ["k"])
    assert state() == corrected
    with pytest.raises(FileNotFoundError):
        ST.read_current(spark, f"{tmp_dir}/nothing", ["k"])


def test_a_base_that_is_gone_is_an_error(spark, tmp_dir):
    from urbanlens.streaming import incremental as ST

    row = spark.createDataFrame([(f"{tmp_dir}/gone", 0)], "path string, through_batch long")
    row.write.parquet(f"{tmp_dir}/t/_BASES")
    spark.createDataFrame([("a", "1", 1)], "k string, v string, batch_id int").write.partitionBy("batch_id").parquet(f"{tmp_dir}/t/batches")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ST.read_current(spark, f"{tmp_dir}/t", ["k"])


def test_failed_publish_keeps_the_version_before(spark, tmp_dir, monkeypatch):
    """A mart fails, or its validation does: it keeps its version, the others move on."""
    from urbanlens.plans import publish as PUB

    class Marts:
        def __init__(self, broken=None, days=(1,)):
            self.spark, self.broken = spark, broken
            self.fct_transit_delays = spark.createDataFrame([("s", 20240101, "k", "bus")],
                                                            "delay_sk string, date_key int, station_key string, transit_mode string")
            self.fct_bike_trips = spark.createDataFrame([(f"t{d}", 20240100 + d, "k") for d in days],
                                                        "trip_sk string, date_key int, start_station_key string")

        def __getattr__(self, name):
            if name == self.broken:
                raise RuntimeError(name)
            return spark.range(1).toDF("x")

    monkeypatch.setattr(PUB, "daily_from_facts", lambda t, b: t.select("date_key"))
    monkeypatch.setattr(PUB.M, "dim_date_over", lambda *facts: spark.range(1).select(F.lit(20240101).alias("date_key")))
    PUB.publish_marts(Marts(), tmp_dir)
    first = PUB.current_version(spark, tmp_dir)
    assert set(first) == set(PUB.PUBLISH_ORDER)
    with pytest.raises(PUB.PublishError, match="dim_station"):
        PUB.publish_marts(Marts(broken="dim_station"), tmp_dir)
    second = PUB.current_version(spark, tmp_dir)
    assert second["dim_station"] == first["dim_station"] and all(second[n] != first[n] for n in first if n != "dim_station")
    empty = Marts()
    empty.fct_bike_trips = empty.fct_bike_trips.limit(0)
    with pytest.raises(PUB.PublishError, match="fct_bike_trips is empty"):
        PUB.publish_marts(empty, tmp_dir)
    third = PUB.current_version(spark, tmp_dir)
    assert third["fct_bike_trips"] == second["fct_bike_trips"] and third["fct_transit_delays"] != second["fct_transit_delays"]
    outcomes = {o.dataset: (o.stage, o.status, o.rows) for o in PUB.publish_datasets(Marts(days=(1, 2)), tmp_dir)}
    assert outcomes["dim_date"] == ("validate", "failed", 0) and outcomes["fct_bike_trips"] == ("load", "success", 2)


def test_nearest_many(spark):
    st = spark.createDataFrame([("o", 43.65, -79.38), ("p", 43.70, -79.38), ("a", 43.66, -79.38)],
                               "station_key string, latitude double, longitude double")
    got = {(r.origin_key, r.rank, r.station_key) for r in G.nearest_many(st, ["o", "p"], 1).collect()}
    assert got == {("o", 1, "a"), ("p", 1, "a")}
