import codecs
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from urbanlens.sources import binary as B
from urbanlens.sources import contracts as V
from urbanlens.sources import delimited as D
from urbanlens.sources import headers as H
from urbanlens.sources import feeds as FD

HEADER = "Date,Time,Day,Station,Code,Min Delay,Min Gap,Bound,Line,Vehicle"
GOOD = [f"2024-01-0{i},0{i}:15,Monday,KING STATION,MUSC,{i},{i + 3},N,YU,{5000 + i}" for i in range(1, 9)]


def write(path, name, text, encoding="utf-8"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "wb") as fh:
        fh.write(text.encode(encoding) if isinstance(text, str) else text)


def subway_contract():
    return V.CONTRACTS["subway_delays"]


def test_read_delimited_null_tokens_and_quotes(spark, tmp_dir):
    write(tmp_dir, "a.csv", 'a,b,c\n"x, y",NULL,\nnull,"",z\n')
    rows = D.read_delimited(spark, tmp_dir).orderBy("c").collect()
    assert [tuple(r) for r in rows] == [("x, y", None, None), (None, None, "z")]


def test_read_delimited_by_name_any_order_and_case(spark, tmp_dir):
    write(tmp_dir, "a.csv", "Route,Location\n504,KING\n")
    write(tmp_dir, "b.csv", "LOCATION,Route,Extra\nQUEEN,501,x\n")
    df = D.read_delimited(spark, tmp_dir, columns=["Route", "Location"], with_path=True)
    assert sorted((r.Route, r.Location) for r in df.collect()) == [("501", "QUEEN"), ("504", "KING")]
    every = D.read_delimited(spark, tmp_dir)
    assert every.columns == ["Route", "Location", "Extra"]
    assert sorted((r.Route, r.Extra) for r in every.collect()) == [("501", "x"), ("504", None)]
    with pytest.raises(ValueError, match="Incident"):
        D.read_delimited(spark, tmp_dir, columns=["Route", "Incident"])


def test_headers_drifted_by_year(spark, tmp_dir):
    write(f"{tmp_dir}/2024", "a.csv", "Route,Location,Line\n504,KING,x\n")
    write(f"{tmp_dir}/2025", "a.csv", "Station,Line\nQUEEN,501\n")
    df = D.read_delimited(spark, tmp_dir, columns=["Route", "Location"], recursive=True,
                          renames={"Line": "Route", "Station": "Location"}, rename_from_year=2025)
    assert sorted(tuple(r) for r in df.collect()) == [("501", "QUEEN"), ("504", "KING")]


def test_header_check_reads_first_lines_only(spark, tmp_dir):
    write(tmp_dir, "a.csv", "\n".join([HEADER] + GOOD) + "\n")
    write(tmp_dir, "b.csv", "\ufeff" + HEADER.replace("Line,", "") + "\n")
    rows = {os.path.basename(r.file_path): r.header for r in V.file_headers(spark, tmp_dir).collect()}
    assert rows == {"a.csv": HEADER, "b.csv": HEADER.replace("Line,", "")}
    checks = {(os.path.basename(r.file_path), r.check, r.column_name) for r in V.header_checks(spark, tmp_dir, subway_contract()).collect()}
    assert checks == {("a.csv", "extra_column", "Vehicle"), ("b.csv", "extra_column", "Vehicle"), ("b.csv", "missing_column", "Line")}


def test_empty_files_quoted_commas_and_odd_paths(spark, tmp_dir):
    """A file of no bytes is reported, a quoted comma stays in its name, and folders and files
    named like patterns are read."""
    write(f"{tmp_dir}/[x] {{y}}", "a*.csv", '"Station, all",Code\n"King, W",1\n')
    write(f"{tmp_dir}/[x] {{y}}", "void.csv", "")
    contract = V.Contract("c", V._cols(("Station", "STRING"), ("Code", "INTEGER")), 1)
    found = V.validate(spark, f"{tmp_dir}/*", contract).collect()
    got = {(os.path.basename(r.file_path), r.check, r.column_name) for r in found}
    assert got == {("a*.csv", "missing_column", "Station"), ("a*.csv", "extra_column", "Station, all"), ("void.csv", "empty_header", None),
                   ("void.csv", "missing_column", "Station"), ("void.csv", "missing_column", "Code")}
    with pytest.raises(V.ContractError):
        V.raise_on_errors(V.validate(spark, f"{tmp_dir}/*", contract))
    df = D.read_delimited(spark, tmp_dir, recursive=True)
    assert [tuple(r) for r in df.collect()] == [("King, W", "1")] and df.columns == ["Station, all", "Code"]


def test_only_empty_files_are_reported(spark, tmp_dir):
    write(tmp_dir, "void.csv", "")
    assert {r.check for r in V.validate(spark, tmp_dir, subway_contract()).collect()} == {"empty_header", "missing_column"}


def test_headers_of_many_files_in_one_job(spark, tmp_dir):
    """Two thousand files in forty folders, three headers: one job lists and reads them, the
    driver gets a row for each folder and header."""
    for i in range(2000):
        head = "A,B" if i % 40 else ("B,A" if i % 80 else "A,B,C")
        write(f"{tmp_dir}/f{i % 40}", f"{i}.csv", f"{head}\n{i},{i}\n")
    found = H.vintages(spark, f"{tmp_dir}/*", D.YEAR_IN_PATH)
    assert {v.header: len(v.paths) for v in found} == {"A,B": 39, "B,A": 25, "A,B,C": 25}  # folder f0 holds two headers
    df = D.read_delimited(spark, f"{tmp_dir}/*", columns=["A", "B"])
    assert df.count() == 2000
    assert df.filter("A = B").count() == 2000


def test_first_lines_in_any_encoding():
    assert H.first_line(iter([]), "UTF-8") is None and H.first_line(iter([b"\n"]), "UTF-8") == ""
    assert H.first_line(iter(["\ufeffA,\u00e9".encode()[:5], "\ufeffA,\u00e9\r\n1".encode()[5:]]), "UTF-8") == "A,\u00e9"
    data = "A,\u6771\n1".encode("utf-16")
    assert H.first_line((data[i:i + 1] for i in range(len(data))), "UTF-16") == "A,\u6771"


def test_value_checks_ignore_header_case(spark, tmp_dir):
    bad = GOOD[:1] + [GOOD[1].replace(",2,5,", ",abc,5,")]
    write(tmp_dir, "a.csv", "\n".join([HEADER.upper()] + bad))
    got = {(r.check, r.column_name, r.value) for r in V.validate(spark, tmp_dir, subway_contract()).collect() if r.severity == "error"}
    assert got == {("type_integer", "Min Delay", "abc")}
    df = D.read_delimited(spark, tmp_dir, with_path=True, null_tokens=())
    assert V.null_profile(df, subway_contract()).count() == len(subway_contract().columns)


def test_copy_positional_modes(spark, tmp_dir):
    write(tmp_dir, "a.csv", 'h1,h2\n1,2\n3,4,5\n"6,7",8\n9\n')
    with pytest.raises(Exception):
        D.copy_positional(spark, tmp_dir, ["a", "b"]).collect()
    r = D.copy_report(D.copy_positional(spark, tmp_dir, ["a", "b"], fail_fast=False)).first()
    assert (r.rows_parsed, r.rows_loaded, r.errors_seen) == (4, 2, 2)


def test_rename_and_strip(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "504", "09:00", "X", "y")],
                               "_id string, Date string, Line string, Time string, Station string, Notes string")
    r = D.rename_drifted(df, {"Line": "Route", "Station": "Location"})
    s = D.strip_extra(r, ["date", "route", "time", "location", "incident"])
    assert s.columns == ["Date", "Route", "Time", "Location", "incident"]
    assert s.first().incident is None


def test_path_year(spark):
    df = spark.createDataFrame([("/d/2019/f.csv",), ("/d/year=2024/f.csv",), ("/d/x/f.csv",)], "file_path string")
    assert [r.file_path for r in D.filter_min_year(df, 2020).collect()] == ["/d/year=2024/f.csv", "/d/x/f.csv"]


def test_contract_valid_file_passes_with_extra_column_warning(spark, tmp_dir):
    write(tmp_dir, "ok.csv", "\n".join([HEADER] + GOOD) + "\n")
    v = V.validate(spark, tmp_dir, subway_contract())
    assert {(r.check, r.severity) for r in v.collect()} == {("extra_column", "warn"), ("min_row_count", "warn")}
    V.raise_on_errors(v)


def test_contract_failures(spark, tmp_dir):
    missing = HEADER.replace("Station,", "")
    write(tmp_dir, "missing.csv", "\n".join([missing] + [",".join(g.split(",")[:3] + g.split(",")[4:]) for g in GOOD]))
    bad = GOOD[:1] + [GOOD[1].replace(",2,5,", ",abc,5,")]
    write(tmp_dir, "badtype.csv", "\n".join([HEADER.upper()] + bad))
    write(tmp_dir, "nulls.csv", "\n".join([HEADER] + [GOOD[0].replace("Monday", "NULL"), GOOD[1].replace(",MUSC,", ",null,")]))
    v = V.validate(spark, tmp_dir, subway_contract()).collect()
    got = {(os.path.basename(r.file_path), r.check, r.column_name) for r in v if r.severity == "error"}
    assert ("missing.csv", "missing_column", "Station") in got
    assert ("badtype.csv", "type_integer", "Min Delay") in got
    assert ("nulls.csv", "null_in_required", "Day") in got
    assert not any(c == "Code" for _, _, c in got)          # NULL accepted in a nullable column
    assert any(r.check == "case_mismatch" for r in v)       # upper-case header only warns
    with pytest.raises(V.ContractError):
        V.raise_on_errors(V.validate(spark, tmp_dir, subway_contract()))


def test_contract_empty_dir(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    assert V.validate(spark, tmp_dir, subway_contract()).count() == 0


def test_reconcile(spark):
    s = spark.createDataFrame([("a", 100), ("b", 0), ("c", 100)], "dataset string, source_rows long")
    l_ = spark.createDataFrame([("a", 99), ("b", 0), ("c", 90)], "dataset string, loaded_rows long")
    assert {r.dataset: r.status for r in V.reconcile(s, l_).collect()} == {"a": "pass", "b": "pass", "c": "fail"}


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    return buf.getvalue()


def test_zip_members(spark, tmp_dir):
    write(tmp_dir, "a.zip", _zip({"folder/": "", "folder/one.csv": "Trip Id,Trip  Duration\n1,60\n",
                                  "folder/two.csv": "Trip Id,Trip  Duration\n2,120\n",
                                  "__MACOSX/folder/._one.csv": "junk", "readme.txt": "x"}))
    df = B.parse_csv_lines(B.zip_csv_lines(B.binary_files(spark, tmp_dir)))
    assert sorted((r.member, r["Trip Id"]) for r in df.collect()) == [("one.csv", "1"), ("two.csv", "2")]


def test_records_keep_quoted_line_breaks(spark, tmp_dir):
    write(tmp_dir, "q.csv", 'a,b\r\n1,"x\ny\x0bz"\r\n2,w\u2028v\n')
    df = B.parse_csv_lines(B.decode_text(B.binary_files(spark, tmp_dir, glob="*.csv")))
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "x\ny\x0bz"), ("2", "w\u2028v")]
    write(f"{tmp_dir}/bad", "b.csv", b"a\n\x81\x8d\xff")
    with pytest.raises(Exception, match="confidence"):
        B.decode_text(B.binary_files(spark, f"{tmp_dir}/bad")).collect()


def test_corrupt_zip_fails(spark, tmp_dir):
    data = bytearray(_zip({"a.csv": "x,y\n" + "1,2\n" * 200}))
    pos = data.find(b"1,2")
    data[pos:pos + 3] = b"9,9"
    write(tmp_dir, "bad.zip", bytes(data))
    with pytest.raises(Exception):
        B.zip_csv_lines(B.binary_files(spark, tmp_dir)).collect()


def test_decode_encodings(spark, tmp_dir):
    write(tmp_dir, "cp.csv", "Name,Value\nCafé,1\n", encoding="cp1252")
    write(tmp_dir, "bom.csv", codecs.BOM_UTF8 + "Name,Value\nZoë,2\n".encode())
    write(tmp_dir, "u16.csv", codecs.BOM_UTF16_LE + "Name,Value\nNaïve,3\n".encode("utf-16-le"))
    df = B.parse_csv_lines(B.decode_text(B.binary_files(spark, tmp_dir)), ["Name", "Value"])
    assert sorted((r.Name, r.Value) for r in df.collect()) == [("Café", "1"), ("Naïve", "3"), ("Zoë", "2")]
    assert B.detect_encoding("abc".encode())[1] == 1.0


def test_xlsx_sheets_and_fallback(spark, tmp_dir):
    write(tmp_dir, "w.xlsx", B.xlsx_bytes(["a", "b"], [["1", None], ["2", "x"]], sheet="delays"))
    write(tmp_dir, "f.xlsx", b"a,b\n3,y\n")
    cells = B.xlsx_cells(B.binary_files(spark, tmp_dir))
    got = sorted(tuple(r) for r in B.cells_to_columns(cells, ["a", "b"]).drop("path").collect())
    assert got == [("1", ""), ("2", "x"), ("3", "y")]
    dims = {r.sheet: (r.n_rows, r.n_cols) for r in B.sheet_dimensions(cells).collect()}
    assert dims["delays"] == (2, 2)
    assert B.xlsx_cells(B.binary_files(spark, tmp_dir, glob="w.xlsx"), sheet="delays").count() == 3
    with pytest.raises(Exception):
        B.xlsx_cells(B.binary_files(spark, tmp_dir, glob="w.xlsx"), sheet="metadata").collect()


@pytest.mark.parametrize("kind", ["zip", "xlsx"])
def test_written_files_are_bounded_in_rows(spark, tmp_dir, kind):
    rows = [(str(i), f'x, "{i}"\ny') for i in range(103)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    for _ in range(2):  # a second run replaces the files of the first
        assert B.write_partition_files(df, tmp_dir, kind, rows_per_file=10) == 11
    files = B.binary_files(spark, tmp_dir, glob=f"*.{kind}")
    if kind == "zip":
        out = B.parse_csv_lines(B.zip_csv_lines(files), ["a", "b"]).drop("member")
    else:
        out = B.cells_to_columns(B.xlsx_cells(files), ["a", "b"])
    assert sorted((r.a, r.b) for r in out.collect()) == sorted(rows)
    assert {r["count"] for r in out.groupBy("path").count().collect()} == {10, 3}


def test_zip_members_are_read_as_a_stream(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(zipfile.ZipFile, "read", None)
    data = _zip({"a.csv": "h\r\n" + "1\r\n" * 25_000 + '"x\ny"'})
    parts = list(B._zip_lines(iter([pd.DataFrame({"path": ["p"], "content": [data]})])))
    assert max(map(len, parts)) == B.ROWS_AT_ONCE and sum(map(len, parts)) == 25_002
    assert parts[-1].line.iloc[-1] == '"x\ny"'


def test_station_feed_documents_are_bounded(spark, tmp_dir):
    feed = spark.range(500).selectExpr("cast(id + 1 as string) as station_id", "concat('s', id) as name", "43.7D as lat", "-79.4D as lon",
                                       "array('g') as groups")
    FD.write_station_feed(feed, tmp_dir, per_doc=10)
    docs = spark.read.schema(FD.FEED_SCHEMA).json(tmp_dir).select(F.size("data.stations").alias("n")).collect()
    assert sum(r.n for r in docs) == 500 and max(r.n for r in docs) < 40  # about 10 each
    assert FD.feed_stations(spark, tmp_dir).count() == 500


def test_station_feed_rules(spark, tmp_dir):
    doc = {"last_updated": 1, "ttl": 10, "data": {"stations": [
        {"station_id": "7", "name": "Seven", "lat": 43.651234567, "lon": -79.38, "groups": ["E-Charging", "Annex "]},
        {"station_id": "7", "name": "Seven again", "lat": 43.65, "lon": -79.38, "groups": []},
        {"station_id": "3", "name": "Three", "lat": 43.7, "lon": -79.4, "groups": ["East"]},
        {"station_id": "4", "name": "Far", "lat": 45.0, "lon": -79.4, "groups": []},
        {"station_id": "0", "name": "Zero", "lat": 43.7, "lon": -79.4, "groups": []},
        {"station_id": "5", "name": "Typo", "lat": 43.7, "lon": -79.4, "groups": ["Watefront"]}]}}
    write(tmp_dir, "feed.json", json.dumps(doc, indent=2))
    got = {r.station_id: (r.station_name, str(r.latitude), r.neighborhood)
           for r in FD.read_station_feed(spark, tmp_dir, multiline=True).collect()}
    assert got == {7: ("Seven", "43.651235", "Annex"), 3: ("Three", "43.700000", "East"),
                   5: ("Typo", "43.700000", "Waterfront")}


def test_select_resources(spark, tmp_dir):
    doc = {"success": True, "result": {"id": "x", "name": "n", "title": "t", "resources": [
        {"id": "1", "name": "Delay Data 2019", "url": "u", "format": "XLSX"},
        {"id": "2", "name": "Delay Data 2023", "url": "u", "format": "csv"},
        {"id": "3", "name": "Delay Data 2024", "url": "u", "format": "CSV"},
        {"id": "4", "name": "Readme", "url": "u", "format": "CSV"}]}}
    write(tmp_dir, "pkg.json", json.dumps(doc))
    cat = spark.read.schema(FD.CATALOGUE_SCHEMA).option("multiLine", True).json(tmp_dir)
    got = sorted((r.id, r.file_name) for r in FD.select_resources(cat, (2020, 2024)).collect())
    assert got == [("2", "delay_data_2023.csv"), ("3", "delay_data_2024.csv")]


def test_csv_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(2, "b", None), (1, "a, quoted", "x")], "id int, name string, note string")
    D.write_delimited(df, tmp_dir, order_by=["id"], columns=["id", "name", "note"])
    back = D.read_delimited(spark, tmp_dir).collect()
    assert [tuple(r) for r in back] == [("1", "a, quoted", "x"), ("2", "b", None)]


def test_rename_drifted_per_row_by_path_year(spark):
    df = spark.createDataFrame([(2024, "504", None), (2025, None, "504")], "yr int, Route string, Line string")
    out = D.rename_drifted(df, {"Line": "Route"}, year_col="yr").select("yr", "Route").orderBy("yr").collect()
    assert [tuple(r) for r in out] == [(2024, "504"), (2025, "504")]


def test_run_summary(spark):
    s = V.run_summary(spark, [("subway", "load", "success", 10, None), ("bus", "validate", "failed", 0, "bad")])
    tot = s.filter(F.col("dataset") == "TOTAL").first()
    assert (tot.status, tot.rows) == ("1/2", 10)


def test_trip_column():
    from urbanlens.plans.analytics import trip_column

    assert trip_column(["Annual Member", "Casual Member"]) == "total_trips"
    assert trip_column(["Annual Member"]) == "member_trips"
    assert trip_column(["Casual Member"]) == "casual_trips"


def test_seed_dataset_views_inventory(spark, tmp_dir):
    from urbanlens.operators import quality as Q
    from urbanlens.operators import upsert as U

    write(f"{tmp_dir}/seed", "codes.csv", "delay_code,delay_description,delay_category\nMUSC,Speed Control,Mechanical\n")
    seed = D.load_seed(spark, f"{tmp_dir}/seed", "delay_code string, delay_description string, delay_category string")
    assert seed.first().delay_category == "Mechanical"
    assert D.lower_columns(seed.toDF("A", "B", "C")).columns == ["a", "b", "c"]
    write(f"{tmp_dir}/files", "a.csv", "k,v\n1,a\n2,b\n")
    write(f"{tmp_dir}/files", "b.csv", "k,v\n2,c\n3,d\n")
    target = spark.createDataFrame([("1", "old"), ("9", "keep")], "k string, v string")
    got = sorted(tuple(r) for r in U.load_dataset(spark, target, f"{tmp_dir}/files", ["k"]).collect())
    assert got == [("1", "a"), ("2", "b"), ("3", "d"), ("9", "keep")]
    seed.createOrReplaceTempView("seed_codes")
    assert [r.missing_table for r in Q.inventory(spark, ["seed_codes", "dim_date"]).collect()] == ["dim_date"]
