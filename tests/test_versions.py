"""Version logs, keyed tables, independent datasets and the facts' layout."""

import glob
import json
import os
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from urbanlens.operators import keyed as K
from urbanlens.operators.versions import VersionConflict, VersionLog
from urbanlens.plans import ingest as IN
from urbanlens.plans import publish as PUB
from urbanlens.sources import contracts as V


def local(path):
    return path.replace("file:", "")


def test_versions_grow_without_a_clock_and_conflicts_are_seen(spark, tmp_dir):
    log = VersionLog(spark, f"{tmp_dir}/log")
    assert log.newest() is None and log.numbers() == []
    log.append({"a": 1}, 0)
    log.append({"a": 2}, 1)
    with pytest.raises(VersionConflict):  # a second writer that started from version 1
        log.append({"a": 3}, 1)
    assert log.newest().body == {"a": 2} and log.push({"a": 4}).number == 3
    assert [log.read(n).body["a"] for n in log.numbers()] == [1, 2, 4]
    assert not [n for n in os.listdir(local(f"{tmp_dir}/log")) if "draft" in n and not n.endswith(".crc")]


def table_of(spark, path, n=200, buckets=16):
    return K.KeyedTable.create(spark.range(n).select(F.col("id").alias("k"), F.lit(0).alias("v")), path, ["k"], buckets)


def test_merge_counts_and_reads_only_touched_buckets(spark, tmp_dir):
    """All files of the buckets that the source does not touch are damaged: the merge doesn't notice."""
    table = table_of(spark, f"{tmp_dir}/t")
    before = table.current().body["folders"]
    source = spark.createDataFrame([(3, 1), (3, 2), (1000, 7), (None, 9)], "k long, v int")
    touched = {r[0] for r in source.select(table._bucket(table.current().body)).collect()}
    saved = {}
    for b, folder in before.items():
        if int(b) not in touched:
            for f in glob.glob(local(f"{tmp_dir}/t/{folder}/_bucket={b}/*.parquet")):
                saved[f] = open(f, "rb").read()
                os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
                open(f, "wb").write(b"damaged")
    result = table.merge(source)
    assert (result.inserted, result.updated, set(result.buckets)) == (2, 1, touched) and 0 < len(touched) < 4
    for f, content in saved.items():
        open(f, "wb").write(content)
    after = table.current().body["folders"]
    assert {b for b in after if after[b] != before.get(b)} == {str(b) for b in touched}
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 202 and rows[3] == 1 and rows[1000] == 7 and rows[None] == 9 and rows[4] == 0
    again = table.merge(source)  # the same rows once more
    assert (again.inserted, again.updated) == (0, 3) and {r.k: r.v for r in table.read().collect()} == rows
    assert len(table.read(table.log.read(1)).collect()) == 200  # the version before is still there


def test_merge_of_nothing_and_into_nothing(spark, tmp_dir):
    none = spark.createDataFrame([], "k long, v int")
    table = K.KeyedTable.create(none, f"{tmp_dir}/t", ["k"], 4)
    assert table.read().collect() == [] and table.merge(none).buckets == ()
    result = table.merge(spark.createDataFrame([(1, 1), (2, 2)], "k long, v int"))
    assert (result.inserted, result.updated) == (2, 0) and table.read().count() == 2
    with pytest.raises(FileNotFoundError):
        K.KeyedTable(spark, f"{tmp_dir}/nowhere").read()


def test_rows_of_one_key_stay_until_a_merge_replaces_them(spark, tmp_dir):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 4)], "k long, v int")
    table = K.KeyedTable.create(df, f"{tmp_dir}/t", ["k"], 4)
    result = table.merge(spark.createDataFrame([(1, 9)], "k long, v int"))
    assert (result.inserted, result.updated) == (0, 1)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, 9), (2, 3), (2, 4)]


def test_two_writers_lose_no_merge(spark, tmp_dir, monkeypatch):
    """Another merge is published between reading and publishing: of other buckets, then of the same."""
    table, other = table_of(spark, f"{tmp_dir}/t"), K.KeyedTable(spark, f"{tmp_dir}/t")
    where = {r.k: r.b for r in table.read().select("k", table._bucket(table.current().body).alias("b")).collect()}
    elsewhere = next(k for k in where if where[k] != where[3])
    between, merged = [], K.KeyedTable._merged

    def interrupted(self, version, staged, touched):
        out = merged(self, version, staged, touched)
        if self is table and between:
            other.merge(spark.createDataFrame([between.pop()], "k long, v int"))
        return out

    monkeypatch.setattr(K.KeyedTable, "_merged", interrupted)
    for expected, k in ((3, elsewhere), (5, 3)):  # one version of each writer
        between.append((k, 50 + expected))
        result = table.merge(spark.createDataFrame([(3, expected)], "k long, v int"))
        assert result.version == expected and (result.inserted, result.updated) == (0, 1)
    rows = {r.k: r.v for r in table.read().collect()}
    assert rows[elsewhere] == 53 and rows[3] == 5


def test_one_failing_dataset_stops_no_other(spark, tmp_dir):
    contract = V.Contract("d", V._cols(("A", "INTEGER", False), ("B", "STRING")), 0)

    def deliver(name, text):
        os.makedirs(local(f"{tmp_dir}/{name}"), exist_ok=True)
        open(local(f"{tmp_dir}/{name}/f.csv"), "w").write(text)
        return f"{tmp_dir}/{name}", contract

    first = IN.ingest_all(spark, f"{tmp_dir}/raw", {"x": deliver("x1", "A,B\n1,a\n"), "y": deliver("y1", "A,B\n1,a\n2,b\n")})
    assert [(o.dataset, o.status, o.rows) for o in first] == [("x", "success", 1), ("y", "success", 2)]
    second = IN.ingest_all(spark, f"{tmp_dir}/raw", {"x": deliver("x2", "A\n1\n"), "y": deliver("y2", "A,B\n1,a\n2,b\n3,c\n"),
                                                     "z": (f"{tmp_dir}/nowhere", contract), "w": deliver("w", "A,B\nq,a\n")})
    got = {o.dataset: (o.stage, o.status, o.rows) for o in second}
    assert got == {"x": ("validate", "failed", 0), "y": ("load", "success", 3), "z": ("load", "failed", 0), "w": ("validate", "failed", 0)}
    assert second[0].error == "missing_column: B" and second[3].error == "type_integer: A"
    paths = IN.snapshot(spark, f"{tmp_dir}/raw", ["x", "y", "z"])
    assert {d: spark.read.parquet(p).count() for d, p in paths.items()} == {"x": 1, "y": 3}
    total = IN.summary(spark, second).filter("dataset = 'TOTAL'").first()
    assert (total.status, total.rows) == ("1/4", 3)


def test_publishers_at_the_same_time_lose_nothing(spark, tmp_dir):
    log = f"{tmp_dir}/_versions/d"

    def publish(i):
        VersionLog(spark, log).push({"path": f"p{i}", "rows": i})

    threads = [threading.Thread(target=publish, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    mine = VersionLog(spark, log)
    assert mine.numbers() == [1, 2, 3, 4] and sorted(mine.read(n).body["rows"] for n in mine.numbers()) == [0, 1, 2, 3]


def test_layout_skips_row_groups_for_one_station_and_for_one_date(spark, tmp_dir):
    df = spark.range(400_000).select(
        F.expr("20200000 + 10000 * (id % 4) + 100 * (1 + id % 12) + 1 + id % 28").cast("int").alias("date_key"),
        F.md5((F.xxhash64("id") % 300).cast("string")).alias("station_key"), F.sha1(F.col("id").cast("string")).alias("sk"))
    PUB.write_clustered(df, f"{tmp_dir}/f", "station_key", 256 << 10)
    assert spark.read.parquet(f"{tmp_dir}/f").count() == 400_000
    ranges = {"date_key": [], "station_key": []}
    for path in glob.glob(local(f"{tmp_dir}/f/*.parquet")):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            for c in range(2):
                column = meta.row_group(g).column(c)
                ranges[column.path_in_schema].append((column.statistics.min, column.statistics.max))
    n = len(ranges["date_key"])
    station = df.select(F.md5(F.lit("7"))).first()[0]
    by_date = sum(lo <= 20210615 <= hi for lo, hi in ranges["date_key"])
    by_station = sum(lo <= station <= hi for lo, hi in ranges["station_key"])
    assert n >= 40 and by_date < n / 3 and by_station < n / 3, (n, by_date, by_station)


def test_facts_are_written_in_one_pass(spark, tmp_dir):
    """Rows of the input are computed once (an accumulator counts them): no sample of the keys is taken before."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(5000).select(F.lit(20240101).alias("date_key"), F.md5(F.col("id").cast("string")).alias("station_key"))
    rows = IN.write_counted(df.mapInArrow(count, df.schema), f"{tmp_dir}/f", lambda d, to: PUB.write_clustered(d, to, "station_key"))
    assert rows == 5000 and seen.value == 5000


def test_log_entries_are_plain_json(spark, tmp_dir):
    VersionLog(spark, f"{tmp_dir}/log").append({"path": "x", "rows": 3}, 0)
    assert json.load(open(local(f"{tmp_dir}/log/000000000001"))) == {"path": "x", "rows": 3}
