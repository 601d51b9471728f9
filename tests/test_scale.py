"""What a query does not do again, or does not gather in one task, on rows of its own."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from urbanlens.functions import columns as X
from urbanlens.operators import keyed
from urbanlens.operators.keyed import KeyedTable
from urbanlens.operators.dedup import duplicate_keys
from urbanlens.plans import registry, registry_loads, warehouse
from urbanlens.plans.staging import SUBWAY_KEY
from urbanlens.sources import contracts as V
from urbanlens.streaming import incremental as ST


@pytest.fixture(scope="module")
def tables(spark):
    from urbanlens.session import shared_dir

    base = shared_dir(spark, f"tests/scale-{os.getpid()}")
    n, day = F.col("id"), F.expr("timestamp '1997-12-20 05:06:00' + make_dt_interval(cast(id % 30 as int))")
    ids = spark.range(1, 121)
    spark.range(5).select(n.cast("int").alias("n_nationkey"), F.concat(F.lit("NATION_"), n).alias("n_name"),
                          (n % 5).cast("int").alias("n_regionkey")).write.parquet(f"{base}/nation.parquet")
    ids.select(n.alias("event_id"), day.alias("ts"), (n % 5).alias("user_id"), n.cast("double").alias("value"),
               F.lit('{"k": 3}').alias("props")).write.parquet(f"{base}/events.parquet")
    ids.select(n.alias("o_orderkey"), (n % 5).alias("o_custkey"), day.alias("o_orderdate")).write.parquet(f"{base}/orders.parquet")
    ids.select(n.alias("l_orderkey"), (n * 7).alias("l_partkey"), (n % 9 + 1).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
               F.lit(9.0).alias("l_quantity"), F.when(n % 2 == 0, "N").otherwise("A").alias("l_returnflag"),
               day.alias("l_shipdate")).write.parquet(f"{base}/lineitem.parquet")
    spark.range(1, 10).select(n.alias("s_suppkey"), F.concat(F.lit("S"), n).alias("s_name"),
                              (n % 5).cast("int").alias("s_nationkey")).write.parquet(f"{base}/supplier.parquet")
    return base


def _published(spark, tables):
    base = registry._PUBLISHED[(spark.sparkContext.applicationId, tables)].removeprefix("file:")
    return {d for d in os.listdir(base) if d[0] not in "._"} if os.path.isdir(base) else set()


def test_only_the_marts_a_query_reads_are_published(spark, tables):
    for key in ("a26_duplicates", "w01_dedup", "u07_user_filter", "v11_reference_records"):
        E.queries()[key](spark, tables).collect()
    assert _published(spark, tables) == set()
    E.queries()["p28_station_picker"](spark, tables).collect()
    assert _published(spark, tables) == {"dim_station"}
    E.queries()["a16_impact"](spark, tables).collect()
    by_type = E.queries()["u06_unpivot"](spark, tables).groupBy("user_type").agg(F.sum("trip_count").alias("n")).collect()
    assert {r["user_type"]: r["n"] for r in by_type} == {"Annual Member": 59, "Casual Member": 60}  # one start time is of another format
    assert _published(spark, tables) == {"dim_station", "dim_date", "dim_weather", "fct_daily_mobility"}
    assert E.queries()["r21_station_trip_metrics"](spark, tables).count() == 1
    assert _published(spark, tables) == {"dim_station", "dim_date", "dim_weather", "fct_daily_mobility", "fct_bike_trips"}


def test_a_feed_read_in_one_pass_is_not_landed(spark, tables):
    at = f"{tables}/"  # the same rows, with nothing landed under this name

    def landed():
        return {name for _, folder, name in warehouse._SEED_PATHS if folder == at}

    once = E.queries()["a26_duplicates"](spark, at).collect()
    assert once and "raw_incidents" not in landed()
    assert sorted(once, key=str) == sorted(duplicate_keys(warehouse.Warehouse(spark, at).raw_subway, SUBWAY_KEY).collect(), key=str)
    again = E.queries()["a26_duplicates"](spark, at)
    assert "raw_incidents" in landed() and all("raw_incidents" in f for f in again.inputFiles())  # what is landed is read
    assert sorted(again.collect(), key=str) == sorted(once, key=str)


def test_trips_read_in_one_pass_are_not_landed(spark, tables):
    at = f"{tables}//"
    once = E.queries()["u07_user_filter"](spark, at)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") and "l_linenumber#" not in plan.split("Relation")[0]  # no trip id, no end is rendered
    assert plan.count("AS start_time") == 2  # rendered once, read once
    once = sorted(once.collect(), key=str)
    assert once and (spark.sparkContext.applicationId, at, "raw_trips") not in warehouse._SEED_PATHS
    wh = warehouse.Warehouse(spark, at)
    assert set(wh.raw_trips.columns) == set(wh.trips_feed.columns)
    assert (spark.sparkContext.applicationId, at, "raw_trips") in warehouse._SEED_PATHS
    assert all("raw_trips" in f for f in warehouse.Warehouse(spark, at).trips_feed.inputFiles())
    assert sorted(E.queries()["u07_user_filter"](spark, at).collect(), key=str) == once


def test_weekdays_are_named_by_lookup(spark, tables):
    from urbanlens.plans import testbed

    inc = testbed.raw_incidents(spark, tables)
    assert "EEEE" not in inc._jdf.queryExecution().optimizedPlan().toString()  # a formatter for each row
    assert inc.filter(~F.col("day").eqNullSafe(F.date_format(F.to_date(F.substring("date", 1, 10)), "EEEE"))).isEmpty()
    assert inc.select("day").distinct().count() == 7
    none = spark.createDataFrame([(None,)], "ts timestamp_ntz").select(testbed._pick(testbed.WEEKDAYS, F.weekday("ts")).alias("day"))
    assert none.first()["day"] is None


def test_days_are_the_same_from_raw_feeds_and_from_facts(spark, tables):
    from urbanlens.plans.publish import daily_from_facts
    from urbanlens.plans.warehouse import Warehouse

    wh = Warehouse(spark, tables)
    from_facts = daily_from_facts(wh.fct_transit_delays, wh.fct_bike_trips)
    assert sorted(from_facts.collect(), key=str) == sorted(wh.fct_daily_mobility.select(*from_facts.columns).collect(), key=str)


def test_times_are_rendered_and_read_by_fields(spark):
    df = spark.createDataFrame([("2024-03-10 02:05:09",), ("0033-12-01 23:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz"))
    text = df.select(X.format_ntz("t", "yyyy-MM-dd HH:mm:ss").alias("a"), X.format_ntz("t", "M/d/yyyy H:mm").alias("b"))
    assert [tuple(r) for r in text.collect()] == [
        ("2024-03-10 02:05:09", "3/10/2024 2:05"), ("0033-12-01 23:00:00", "12/1/0033 23:00"),
        ("null-null-null null:null:null", "null/null/null null:null")]
    assert "format_string" not in X.format_ntz("t", "HH:mm")._jc.toString()
    cases = {"3/10/2024 2:05": "2024-03-10 02:05:00", " 12/1/2024  23:59 ": "2024-12-01 23:59:00", "2/30/2024 1:00": None,
             "1/2/2024 24:00": None, "1/2/2024 3:60": None, "1/2/2024 3:4": None, "2024-01-02 03:04": None, "x1/2/2024 3:04": None,
             "1/2/2024 3:04\n": "2024-01-02 03:04:00", "1/2/2024 3:04\nx": None, "": None, "1/2/0000 3:04": "0000-01-02 03:04:00"}
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.safe_timestamp("t").cast("string").alias("ts"))
    assert {r["t"]: r["ts"] for r in got.collect()} == cases
    assert "transform" not in X.safe_timestamp("t")._jc.toString()  # an interpreted lambda for each row
    keys = spark.createDataFrame([("2024-03-10",), ("0033-12-01",), (None,)], "d string").select(X.date_key(F.col("d").cast("date")).alias("k"))
    assert [r["k"] for r in keys.collect()] == [20240310, 331201, None]


def test_a_bucket_is_the_work_of_several_tasks(spark, tmp_dir):
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # what is small would be merged
    try:
        rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
        table = KeyedTable.create(rows.unionByName(rows.filter("id < 10")), f"{tmp_dir}/t", ["k"], 1)
        result = table.merge(rows.filter("v >= 100").withColumn("v", -F.col("v")).unionByName(
            spark.createDataFrame([("new", 1), (None, 2)], "k string, v long")))
        assert (result.inserted, result.updated) == (2, 100)
        for version in (table.log.read(1), table.log.read(2)):
            assert len(table.read(version).inputFiles()) > 1
        assert table.read().count() == 212
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


@pytest.mark.parametrize("order", [None, ["w"], ["W", "v"]])
@pytest.mark.parametrize("hot", [False, True])
def test_a_source_is_landed_as_it_comes_and_shuffles_once(spark, tmp_dir, monkeypatch, hot, order):
    """Only one with a hot key is reduced, and shuffled, before it is dealt; the landed rows don't stay."""
    landed, land = [], keyed.land

    def watched(df, *args, **kwargs):
        path = land(df, *args, **kwargs)
        landed.append((path, "Exchange" in df._jdf.queryExecution().executedPlan().toString(), spark.read.parquet(path).count()))
        return path

    monkeypatch.setattr(keyed, "land", watched)
    if hot:
        monkeypatch.setattr(keyed, "HOT_ROWS", 50)
    old = [("a", 1, 1), ("a", 2, 2), ("b", 3, 3), ("b", 3, 3), (None, 4, 4), ("z", None, 5)]
    new = [("a", 9, 7), ("a", 8, 8), ("c", None, 3), ("c", 1, None), (None, 6, 6), (None, None, 7), ("d", 1, 1)]
    new += [("hot", i * 7 % 1000, i) for i in range(1, 1001)]
    schema = "k string, v int, w int"
    table = KeyedTable.create(spark.createDataFrame(old, schema), f"{tmp_dir}/t", ["k"], 4)
    result = table.merge(spark.createDataFrame(new, schema), order)

    def rank(r):  # nulls first, the given columns before the others
        return [(r[i] is not None, r[i] or 0) for i in ((1, 2) if order is None else (2, 1))]

    taken = {r[0]: r for r in sorted(new, key=rank, reverse=True)}
    expected = [r for r in old if r[0] not in taken] + list(taken.values())
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(expected, key=str)
    assert (result.inserted, result.updated) == (3, 2)
    assert [(shuffled, n) for _, shuffled, n in landed] == ([(False, 1007), (True, 5)] if hot else [(False, 1007)])
    assert not any(os.path.exists(path.removeprefix("file:")) for path, _, _ in landed)
    assert all(f.endswith(".zstd.parquet") for f in table.read().inputFiles())


def test_merge_counts_leave_no_landed_source(spark, tables):
    from urbanlens.session import shared_dir

    folder = shared_dir(spark, "tables").removeprefix("file:")
    found = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    early = (F.col("start_time") < F.lit("1998-01-01").cast("timestamp_ntz")).cast("int")
    rows, old = warehouse.Warehouse(spark, tables).stg_trips.agg(F.count(F.lit(1)), F.sum(early)).first()
    assert tuple(E.queries()["s18b_merge_stats"](spark, tables).first()) == (rows - old, old) and 0 < old < rows
    assert not [d for d in set(os.listdir(folder)) - found if d.startswith("merge-source")]


def test_columns_that_cannot_violate_are_not_taken_apart(spark):
    df = spark.createDataFrame([("f", "1", None), ("f", "x", "NULL"), ("g", "y", "t")], "file_path string, a string, b string")
    loose = V.Contract("d", (V.ColumnSpec("a", "STRING"), V.ColumnSpec("b", "STRING")), 0)
    found = V.value_checks(df, loose)
    assert found.count() == 0 and "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    strict = V.Contract("d", (V.ColumnSpec("a", "INTEGER"), V.ColumnSpec("b", "STRING", False)), 0)
    assert sorted(tuple(r) for r in V.value_checks(df, strict).collect()) == [
        ("f", "null_in_required", "b", "NULL", 2, "error"), ("f", "type_integer", "a", "x", 1, "error"), ("g", "type_integer", "a", "y", 1, "error")]


def test_a_dataset_that_is_not_delivered_is_not_written(spark, tables, tmp_dir):
    out = registry_loads._deliver(spark, tables, f"{tmp_dir}/later", ("weather_daily",), ("bike_trips",))
    assert set(os.listdir(f"{tmp_dir}/later".removeprefix("file:"))) == set(out) - {"bike_trips"}


def test_deliveries_are_compressed_and_read_back(spark, tmp_dir):
    rows = spark.range(50).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, F.lit('a, "b"')).alias("v"))
    ST.land_in_batches(rows, f"{tmp_dir}/landing", "k", 2)
    files = [f for _, _, fs in os.walk(f"{tmp_dir}/landing".removeprefix("file:")) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    ST.load_incrementally(spark, f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt", rows.columns)
    assert sorted(ST.read_current(spark, f"{tmp_dir}/table", ["k"]).collect(), key=str) == sorted(rows.collect(), key=str)
