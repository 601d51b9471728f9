"""Metrics of runs, the ledger of files, nearest stations of all, aliases."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from urbanlens.operators import geo as G
from urbanlens.operators import quality as Q
from urbanlens.operators import resolve as E
from urbanlens.operators import upsert as U
from urbanlens.operators.history import MetricHistory, volume_metrics
from urbanlens.operators.ledger import FileLedger
from urbanlens.plans import testbed as T
from urbanlens.sources import delimited as D
from urbanlens.functions.geo import haversine_km


def test_the_fifteenth_run_is_flagged(spark, tmp_dir):
    """Fourteen runs pass as training; the fifteenth loses most rows; repeated runs change nothing."""
    history = MetricHistory(spark, f"{tmp_dir}/metrics")
    statuses = []
    for run in range(1, 15):
        loaded = spark.range(100 + run % 3).withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        metrics = volume_metrics(loaded, "t", "at", F.expr(f"date_add('2024-01-01', {run % 2})"))
        statuses += [r.status for r in history.record(run, metrics).collect()]
    assert set(statuses) == {"training"} and len(statuses) == 28
    short = volume_metrics(spark.range(40).withColumn("at", F.lit("2024-01-01").cast("timestamp")), "t", "at", F.expr("date'2024-01-02'"))
    for _ in range(2):  # the same run twice
        got = {r.metric: (r.value, r.status) for r in history.record(15, short).collect()}
        assert got == {"rows": (40.0, "anomaly"), "age_days": (1.0, "pass")}
    assert history.read().count() == 30
    good = volume_metrics(spark.range(101), "t")
    assert [r.status for r in history.record(15, good).collect()] == ["pass"]  # corrected, in place of both rows
    assert history.read().count() == 29
    other = history.record(16, volume_metrics(spark.range(0), "new"))
    assert [(r.table_name, r.status) for r in other.collect()] == [("new", "training")]


def test_anomalies_at_the_bound_are_exact(spark):
    values = [11, 19] * 7 + [15 + 8]  # mean 15, spread 4.15...
    df = spark.createDataFrame(list(enumerate(values)), "t int, v int")
    assert Q.volume_anomalies(df, "t", "v", 14, 2.0).count() == 0
    assert [r.t for r in Q.volume_anomalies(df.withColumn("v", F.expr("if(t = 14, 24, v)")), "t", "v", 14, 2.0).collect()] == [14]
    two = df.withColumn("g", F.lit("a")).unionByName(df.limit(5).withColumn("g", F.lit("b")))
    assert Q.volume_anomalies(two, "t", "v", 4, 1.0, ["g"]).filter("g = 'b'").count() == 0


def test_load_freshness(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    loaded = spark.read.parquet(f"{tmp_dir}/t")
    status = [Q.load_freshness(loaded, F.date_add(F.current_date(), days)).first().status for days in (0, 60, 200)]
    assert status == ["pass", "warn", "error"]


def test_ledger_in_one_step(spark, tmp_dir):
    folder = tmp_dir.replace("file:", "")
    os.makedirs(f"{folder}/files/in")

    def put(name, data):
        open(f"{folder}/files/{name}", "wb").write(data)

    big = os.urandom(5 << 20)
    put("a", b"1234"), put("in/b [x]", big), put("void", b""), put("gone", b"x")
    ledger = FileLedger(spark, f"{tmp_dir}/ledger")
    first = ledger.update(f"{tmp_dir}/files")
    assert (first.added, first.replaced, first.pruned, first.version) == (4, 0, 0, 1)
    got = {os.path.basename(r.path): (r.size_bytes, r.sha256) for r in ledger.read().collect()}
    assert got["b [x]"] == (5 << 20, hashlib.sha256(big).hexdigest()) and got["void"] == (0, hashlib.sha256(b"").hexdigest())
    put("a", b"12345"), put("new", b"n")
    os.remove(f"{folder}/files/gone")
    assert {os.path.basename(r.path) for r in ledger.changed(f"{tmp_dir}/files").collect()} == {"a", "new"}
    second = ledger.update(f"{tmp_dir}/files")
    assert (second.added, second.replaced, second.pruned, second.version) == (1, 1, 1, 2)
    third = ledger.update(f"{tmp_dir}/files")
    assert (third.added, third.replaced, third.pruned) == (0, 0, 0) and ledger.read().count() == 4
    assert {r.sha256 for r in U.file_manifest(spark, f"{tmp_dir}/files").collect()} == {r.sha256 for r in ledger.read().collect()}


@pytest.mark.parametrize("n", [1, 3])
def test_nearest_all_equals_brute_force(spark, n):
    """A town, two places with many stations, the date line, the poles, and one far away."""
    rng = random.Random(5)
    rows = [(f"t{i:03d}", 43.6 + rng.random() * 0.2, -79.5 + rng.random() * 0.3) for i in range(120)]
    rows += [(f"s{i}", 43.7, -79.4) for i in range(8)] + [(f"d{i}", rng.uniform(-1, 1), rng.choice([179.99, -179.99])) for i in range(10)]
    rows += [(f"p{i}", rng.choice([89.9, -89.95]), rng.uniform(-180, 180)) for i in range(8)] + [("far", -40.0, 20.0), ("none", None, 1.0)]
    st = spark.createDataFrame(rows, "station_key string, latitude double, longitude double")
    got = {}
    df = G.nearest_all(st, n)
    assert "NestedLoop" not in df._jdf.queryExecution().toString()
    for r in df.collect():
        got.setdefault(r.origin_key, {})[r.rank] = (r.station_key, r.distance_km)
    a, b = st.filter("latitude is not null").alias("a"), st.filter("latitude is not null").alias("b")
    pairs = a.crossJoin(b).filter("a.station_key <> b.station_key").select(
        F.col("a.station_key").alias("o"), F.col("b.station_key").alias("k"),
        haversine_km(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")).alias("d")).collect()
    best = {}
    for p in pairs:
        best.setdefault(p.o, []).append((p.d, p.k))
    assert got.keys() == best.keys() == {r[0] for r in rows if r[1] is not None}
    for o, found in best.items():
        expected = sorted(found)[:n]
        assert [k for _, k in sorted((rank, v[0]) for rank, v in got[o].items())] == [k for _, k in expected]
        assert got[o][n][1] == pytest.approx(expected[-1][0], abs=0.006)


def test_nearest_all_of_few(spark):
    st = spark.createDataFrame([("a", 1.0, 1.0), ("b", -60.0, 170.0)], "station_key string, latitude double, longitude double")
    assert {(r.origin_key, r.rank, r.station_key) for r in G.nearest_all(st, 5).collect()} == {("a", 1, "b"), ("b", 1, "a")}
    assert G.nearest_all(st.limit(1), 2).collect() == [] and G.nearest_all(st.limit(0), 2).collect() == []


def test_minmax_has_no_window(spark):
    scaled = G.minmax_scale(spark.range(5).withColumnRenamed("id", "v"), "v")
    assert "Window" not in scaled._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.radius for r in scaled.collect())[0::4] == [50.0, 500.0] or len({r.radius for r in scaled.collect()}) == 5


def test_aliases_resolve_in_their_own_order(spark):
    registry = spark.createDataFrame([("ST_004", "Canon", "YU", 3), ("ST_007", "Other", "BD", 6), ("ST_009", "Third", "BD", 8),
                                      ("ST_015", "Fifth", "YU", 14), ("ST_016", "Sixth", "YU", 15)],
                                     "station_key string, canonical_station_name string, line_code string, ordinal int")
    names = spark.createDataFrame([("TRACK LEVEL 3",), ("TRACK LEVEL 5",), ("AT LEVEL 5",), ("TRACK LEVEL 8",)], "name string")
    got = {r["name"]: r.station_key for r in E._longest_contained(names, T.station_lookup(registry), 5).collect()}
    assert got == {"TRACK LEVEL 3": "ST_004", "TRACK LEVEL 5": "ST_007", "AT LEVEL 5": "ST_009", "TRACK LEVEL 8": "ST_016"}


def test_counting_copy_is_linear_in_the_row(spark, tmp_dir):
    """A row of a megabyte with 20,000 fields (the parser's limit), and one whose commas are quoted."""
    folder = tmp_dir.replace("file:", "")
    os.makedirs(folder)
    with open(f"{folder}/f.csv", "w") as f:
        f.write("a,b\n1,2\n" + ("x" * 50 + ",") * 20_000 + "y\n" + '"' + "q,""" * 300_000 + '",z\n')
    got = D.copy_report(D.copy_positional(spark, tmp_dir, ["a", "b"], fail_fast=False)).first()
    assert (got.rows_parsed, got.rows_loaded, got.errors_seen) == (3, 2, 1)
