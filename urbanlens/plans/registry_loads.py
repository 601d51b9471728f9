"""Registered checks of deviating headers, manifests, seeds, dataset loads and sinks.

As in ``registry_sources``, each writes data that Spark derives from the given
tables into the shared folder, in the state under test, and returns what the
operator makes of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from urbanlens.operators import upsert as U
from urbanlens.operators.keyed import KeyedTable, load_files
from urbanlens.plans import ingest as IN
from urbanlens.plans import testbed as T
from urbanlens.plans.registry_sources import MERGE_BUCKETS, SUBWAY_FILE_HEADER, delivered
from urbanlens.plans.warehouse import Warehouse
from urbanlens.session import land, shared_dir
from urbanlens.sources import contracts as V
from urbanlens.sources import delimited as D
from urbanlens.sources import feeds as FD

CATALOGUE_YEARS = (2010, 2029)


def _scratch(spark, name: str) -> str:
    return shared_dir(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")


def _write(df, path: str) -> None:
    df.write.option("header", True).option("nullValue", "NULL").csv(path)


def _order_number():
    return F.split("trip_id", "-")[0].cast("long")


def v01_header_checks(spark, sf_dir):
    """The five datasets in deliveries of deviating headers (a name in another case, the last
    column missing, one more column, a quoted name with a comma, and a file of no bytes), in
    folders whose names are patterns: what the checks find, with the rows it touches."""
    base, out = _scratch(spark, "v01"), None
    for name, raw in delivered(Warehouse(spark, sf_dir)).items():
        names = V.CONTRACTS[name].names
        digit = F.substring(F.md5(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))), 1, 1)
        headers = {
            "case": (digit < "5", [n.upper() if i == 1 else n for i, n in enumerate(names)]),
            "less": ((digit >= "5") & (digit <= "9"), names[:-1]),
            "more": ((digit > "9") & (digit <= "c"), [*names, "Remarks"]),
            "[d] e": (digit > "c", [f"{n}, all" if i == 1 else n for i, n in enumerate(names)])}
        folder = f"{base}/{name}"
        for delivery, (mine, header) in headers.items():
            own = [F.col(f"`{names[i]}`") if i < len(names) else F.lit("none") for i in range(len(header))]
            _write(raw.filter(mine).select(*[c.alias(h) for c, h in zip(own, header)]), f"{folder}/{delivery}")
        raw.limit(0).select(F.lit("").alias("value")).write.text(f"{folder}/void")
        of_file = F.regexp_extract("file_path", rf"/{name}/([^/]+)/[^/]*$", 1).alias("delivery")
        found = V.header_checks(spark, f"{folder}/*", V.CONTRACTS[name]).select(of_file, "check", "column_name", "severity").distinct()
        rows = D.read_delimited(spark, f"{folder}/*", with_path=True).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.withColumn("file_path", F.url_decode("file_path"))  # once a file, not once a row
        rows = rows.groupBy(of_file).agg(F.sum("n_rows").alias("n_rows"))
        part = found.join(rows, "delivery", "left").withColumn("dataset", F.lit(name)).fillna(0, ["n_rows"])
        out = part if out is None else out.unionByName(part)
    return out


def _deliver(spark, sf_dir, base, without_last=(), not_delivered=()):
    """The five datasets as files; some without their last column, some not at all."""
    out = {}
    for name, raw in delivered(Warehouse(spark, sf_dir)).items():
        contract = V.CONTRACTS[name]
        if name not in not_delivered:
            _write(raw.drop(contract.names[-1]) if name in without_last else raw, f"{base}/{name}")
        loose = tuple(V.ColumnSpec(c.name, "STRING") for c in contract.columns)  # raw text has bad numbers
        out[name] = (f"{base}/{name}", V.Contract(name, loose, 0))
    return out


def v14_run_summary(spark, sf_dir):
    """Five datasets ingested on their own; the weather files lack a column and fail."""
    base = _scratch(spark, "v14")
    deliveries = _deliver(spark, sf_dir, f"{base}/files", ("weather_daily",))
    return IN.summary(spark, IN.ingest_all(spark, f"{base}/raw", deliveries))


def s20b_independent(spark, sf_dir):
    """Rows of each dataset's current version after two runs, the second of which delivers no
    trips and broken weather files: those keep their versions before."""
    base = _scratch(spark, "s20b")
    deliveries = _deliver(spark, sf_dir, f"{base}/files")
    IN.ingest_all(spark, f"{base}/raw", deliveries)
    again = _deliver(spark, sf_dir, f"{base}/later", ("weather_daily",), ("bike_trips",))
    later = IN.ingest_all(spark, f"{base}/raw", again)
    failed = spark.createDataFrame([(o.dataset, o.status) for o in later], "dataset string, second_run string")
    out = None
    for name, path in IN.snapshot(spark, f"{base}/raw", list(deliveries)).items():
        part = spark.read.parquet(path).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out.join(failed, "dataset")


def s11_catalogue(spark, sf_dir):
    """A catalogue of a CSV and an XLSX resource for each year of the incidents."""
    path = _scratch(spark, "s11")
    years = T.raw_subway(spark, sf_dir).select(F.substring("date", 1, 4).alias("y")).distinct()
    both = years.withColumn("format", F.explode(F.array(F.lit("csv"), F.lit("XLSX"))))
    resource = F.struct(F.concat("y", F.lit("-"), "format").alias("id"), F.concat(F.lit("Subway Delay ("), "y", F.lit(") data")).alias("name"),
                        "format", F.lit(True).alias("datastore_active"))
    document = both.agg(F.collect_list(resource).alias("resources"))  # two for each year
    document.select(F.to_json(F.struct(F.lit(True).alias("success"), F.struct("resources").alias("result"))).alias("value")).write.text(path)
    catalogue = spark.read.schema(FD.CATALOGUE_SCHEMA).json(path)
    return FD.select_resources(catalogue, CATALOGUE_YEARS).select("name", "format", "year", "file_name")


def s13_changed_files(spark, sf_dir):
    """Trips in two deliveries: by the manifests, only the files of the second are loaded."""
    raw, path = T.raw_trips(spark, sf_dir), _scratch(spark, "s13")
    late = _order_number() % 5 == 0
    _write(raw.filter(~late), f"{path}/first")
    before = spark.read.parquet(land(U.file_manifest(spark, path), "manifest"))
    _write(raw.filter(late), f"{path}/later")
    changed = U.manifest_changes(before, U.file_manifest(spark, path))
    return D.read_delimited(spark, [r["path"] for r in changed.select("path").collect()], columns=raw.columns)


def s16_strip_extra(spark, sf_dir):
    """Incidents from files with a column too many and one too few."""
    raw, path = T.raw_subway(spark, sf_dir), _scratch(spark, "s16")
    _write(raw.drop("min_gap").withColumn("remarks", F.lit("none")), path)
    return D.strip_extra(D.read_delimited(spark, path), raw.columns)


def s17_seed(spark, sf_dir):
    """The station reference as a typed seed."""
    ref, path = Warehouse(spark, sf_dir).bike_station_ref, _scratch(spark, "s17")
    ref.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return D.load_seed(spark, path, ", ".join(f"{n} {t}" for n, t in ref.dtypes))


def _loaded(spark, sf_dir):
    """Two files' folders, with their columns in another order, merged into a loaded part."""
    raw, path = T.raw_trips(spark, sf_dir), _scratch(spark, "s19")
    target = raw.filter(_order_number() % 5 != 0).withColumn("trip_duration", F.lit("1"))
    _write(raw.filter(_order_number() % 5 == 0), f"{path}/a")
    _write(raw.filter(_order_number() % 5 == 1).select(*reversed(raw.columns)), f"{path}/b")
    table = KeyedTable.create(target, f"{path}/table", ["trip_id"], MERGE_BUCKETS)
    return table, load_files(table, [f"{path}/a", f"{path}/b"], raw.columns)


def s19_load_dataset(spark, sf_dir):
    return _loaded(spark, sf_dir)[0].read()


def s19b_load_counts(spark, sf_dir):
    """Rows that load has inserted and updated."""
    result = _loaded(spark, sf_dir)[1]
    return spark.createDataFrame([(result.inserted, result.updated)], "inserted long, updated long")


def s22_sorted_sink(spark, sf_dir):
    """Weather days through the sorted CSV sink and back."""
    raw, path = T.raw_weather(spark, sf_dir), _scratch(spark, "s22")
    D.write_delimited(raw, path, ["date_time"], sorted(raw.columns), "NULL")
    return D.read_delimited(spark, path, columns=raw.columns)


def p32_lower_columns(spark, sf_dir):
    raw, path = T.raw_subway(spark, sf_dir), _scratch(spark, "p32")
    _write(raw.toDF(*SUBWAY_FILE_HEADER), path)
    return D.lower_columns(D.read_delimited(spark, path))


LOAD_QUERIES = {
    "v01_header_checks": v01_header_checks,
    "v14_run_summary": v14_run_summary,
    "s11_catalogue": s11_catalogue,
    "s13_changed_files": s13_changed_files,
    "s16_strip_extra": s16_strip_extra,
    "s17_seed": s17_seed,
    "s19_load_dataset": s19_load_dataset,
    "s19b_load_counts": s19b_load_counts,
    "s20b_independent": s20b_independent,
    "s22_sorted_sink": s22_sorted_sink,
    "p32_lower_columns": p32_lower_columns,
}
