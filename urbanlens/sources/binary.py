"""Binary inputs: spreadsheets, zip archives, encoded text.

Each file is one ``binaryFile`` row, decoded inside an executor task by a
small per-file helper in ``mapInPandas`` (stdlib ``zipfile``/XML and codecs);
the helpers emit *lines of text* or *cells*, and everything after that — CSV
parsing, typing, validation — is ordinary DataFrame work. Files are
distributed one per task, so a directory of thousands of archives decodes in
parallel; a single file is bounded by the binaryFile source (2 GB).
"""

from __future__ import annotations

import codecs
import io
import itertools
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from typing import IO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZIP_MAGIC = b"PK\x03\x04"
MIN_CONFIDENCE = 0.7
LINES_SCHEMA = "path string, member string, line_no long, line string"
CELLS_SCHEMA = "path string, sheet string, row_no long, cells array<string>"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def binary_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None,
                 recursive: bool = True) -> DataFrame:
    """Every file under ``paths`` (optionally filtered by a glob) as (path, content)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(paths if isinstance(paths, str) else list(paths)).select("path", "content")


# --- text decoding (S06) ------------------------------------------------------------

def detect_encoding(data: bytes) -> tuple[str, float]:
    """BOM first; then UTF-16 by NUL-byte position; then strict UTF-8; else cp1252 at 0.7."""
    for bom, enc in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"),
                     (codecs.BOM_UTF16_BE, "utf-16")):
        if data.startswith(bom):
            return enc, 1.0
    sample = data
    if len(sample) >= 2:
        odd_nul = sample[1::2].count(0) / max(1, len(sample[1::2]))
        even_nul = sample[0::2].count(0) / max(1, len(sample[0::2]))
        if odd_nul > 0.3 and even_nul < 0.05:
            return "utf-16-le", min(1.0, 0.5 + odd_nul)
        if even_nul > 0.3 and odd_nul < 0.05:
            return "utf-16-be", min(1.0, 0.5 + even_nul)
    try:
        data.decode("utf-8")
        return "utf-8", 1.0
    except UnicodeDecodeError:
        pass
    try:
        data.decode("cp1252")
        return "cp1252", MIN_CONFIDENCE
    except UnicodeDecodeError:  # bytes that neither encoding has: the caller rejects the file
        return "cp1252", 0.0


ROWS_AT_ONCE = 10_000
ROWS_PER_FILE = 50_000  # of the written files, whatever the size of the table


def _records(lines: Iterable[str]) -> Iterator[str]:
    """Delimited records: split at CR LF, LF or CR, but not inside quotes."""
    open_quote, held = False, []
    for line in lines:
        line = line.removesuffix("\n")
        held.append(line)
        open_quote ^= line.count('"') % 2 == 1
        if not open_quote:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def _numbered(path: str, member: str | None, data: IO[bytes], encoding: str) -> Iterator[pd.DataFrame]:
    """The records of one stream, a bounded number at a time."""
    out = []
    for i, record in enumerate(_records(io.TextIOWrapper(data, encoding))):
        out.append((path, member, i, record))
        if len(out) >= ROWS_AT_ONCE:
            yield pd.DataFrame(out, columns=["path", "member", "line_no", "line"])
            out = []
    yield pd.DataFrame(out, columns=["path", "member", "line_no", "line"])


def _decode_lines(it: Iterator[pd.DataFrame], min_conf: float) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            enc, conf = detect_encoding(bytes(content))
            if conf < min_conf:
                raise ValueError(f"{path}: encoding confidence {conf:.2f} below {min_conf}")
            yield from _numbered(path, None, io.BytesIO(content), enc)


def decode_text(files: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(path, line_no, line) in UTF-8, whatever the file's encoding (BOM stripped)."""
    return files.mapInPandas(lambda it: _decode_lines(it, min_confidence), LINES_SCHEMA)


# --- zip archives (S08/S09) ------------------------------------------------------------

def _zip_lines(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
                bad = zf.testzip()
                if bad is not None:
                    raise ValueError(f"{path}: CRC check failed for {bad}")
                for info in zf.infolist():
                    name = info.filename
                    if info.is_dir() or name.startswith("__MACOSX/") or not name.lower().endswith(".csv"):
                        continue
                    member = name.rsplit("/", 1)[-1]  # prefix flattened
                    with zf.open(info) as data:
                        yield from _numbered(path, member, data, "utf-8-sig")


def zip_csv_lines(files: DataFrame) -> DataFrame:
    """Lines of every CSV member (directories and __MACOSX skipped, CRC verified)."""
    return files.mapInPandas(_zip_lines, LINES_SCHEMA)


def parse_csv_lines(lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lines -> text columns: line 0 of each file/member is the header and is dropped;
    quoted fields are handled by ``from_csv``. ``columns`` defaults to the first header seen."""
    if columns is None:
        first = lines.filter(F.col("line_no") == 0).select("line").first()
        if first is None:
            raise ValueError("no header line")
        columns = [c.strip().strip('"') for c in next(iter(__import__("csv").reader([first[0]])))]
    schema = ", ".join(f"`{c}` string" for c in columns)
    body = lines.filter((F.col("line_no") > 0) & (F.length("line") > 0))
    parsed = body.select("path", "member", F.from_csv("line", schema, {"quote": '"', "escape": '"'}).alias("r"))
    return parsed.select("path", "member", *[F.col("r").getField(c).alias(c) for c in columns])


# --- spreadsheets (S03, S05) ------------------------------------------------------------

def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_rows(zf: zipfile.ZipFile, sheet: str | None) -> tuple[str, list[list[str]]]:
    wb = ElementTree.fromstring(zf.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", _NS)
    if not sheets:
        raise ValueError("workbook has no sheets")
    chosen = sheets[0] if sheet is None else next((s for s in sheets if s.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"sheet {sheet!r} not found")
    rid = chosen.get(f"{{{_REL_NS}}}id")
    target = "worksheets/sheet1.xml"
    if "xl/_rels/workbook.xml.rels" in zf.namelist():
        rels = ElementTree.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
        for r in rels:
            if r.get("Id") == rid:
                target = r.get("Target").lstrip("/").removeprefix("xl/")
    shared: list[str] = []
    if "xl/sharedStrings.xml" in zf.namelist():
        sst = ElementTree.fromstring(zf.read("xl/sharedStrings.xml"))
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in sst.findall("m:si", _NS)]
    ws = ElementTree.fromstring(zf.read(f"xl/{target}"))
    rows = []
    for row in ws.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str] = {}
        for c in row.findall("m:c", _NS):
            t = c.get("t")
            if t == "inlineStr":
                val = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
            else:
                v = c.find("m:v", _NS)
                val = "" if v is None or v.text is None else v.text
                if t == "s" and val != "":
                    val = shared[int(val)]
            cells[_col_index(c.get("r"))] = val
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i, "") for i in range(width)])  # missing cell -> ""
    return chosen.get("name"), rows


def _xlsx_cells(it: Iterator[pd.DataFrame], sheet: str | None) -> Iterator[pd.DataFrame]:
    def batches(path, name, rows):
        rows = iter(rows)
        numbers = itertools.count()
        while out := [(path, name, i, r) for r, i in zip(itertools.islice(rows, ROWS_AT_ONCE), numbers)]:
            yield pd.DataFrame(out, columns=["path", "sheet", "row_no", "cells"])

    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            data = bytes(content)
            if not data.startswith(ZIP_MAGIC):  # S05: not a workbook -> CSV text
                import csv

                yield from batches(path, None, csv.reader(io.StringIO(data.decode("utf-8-sig"))))
                continue
            with zipfile.ZipFile(io.BytesIO(data)) as zf:
                name, rows = _sheet_rows(zf, sheet)
            yield from batches(path, name, rows)


def xlsx_cells(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """(path, sheet, row_no, cells) from the first or a named sheet; NULL cell -> ''."""
    return files.mapInPandas(lambda it: _xlsx_cells(it, sheet), CELLS_SCHEMA)


def cells_to_columns(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row 0 of each file is the header; data rows become text columns by position
    (an empty or absent cell reads as '')."""
    body = cells.filter(F.col("row_no") > 0)
    return body.select("path", *[F.coalesce(F.get(F.col("cells"), i), F.lit("")).alias(c)
                                 for i, c in enumerate(columns)])


def sheet_dimensions(cells: DataFrame) -> DataFrame:
    """Data rows and columns per file."""
    return cells.groupBy("path", "sheet").agg((F.count(F.lit(1)) - 1).alias("n_rows"),
                                               F.max(F.size("cells")).alias("n_cols"))


# --- writers used to materialise derived inputs (tests and registered checks) ---------------

def xlsx_bytes(header: Sequence[str], rows: Sequence[Sequence[str | None]], sheet: str = "Sheet1") -> bytes:
    """A minimal one-sheet workbook with inline strings."""
    def cell(ci: int, ri: int, v: str | None) -> str:
        ref = ""
        n = ci + 1
        while n:
            n, rem = divmod(n - 1, 26)
            ref = chr(65 + rem) + ref
        if v is None:
            return ""
        esc = v.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        return f'<c r="{ref}{ri + 1}" t="inlineStr"><is><t>{esc}</t></is></c>'

    body = "".join(f'<row r="{ri + 1}">' + "".join(cell(ci, ri, v) for ci, v in enumerate(r)) + "</row>"
                   for ri, r in enumerate([list(header)] + [list(r) for r in rows]))
    m = _NS["m"]
    files = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            "</Types>"),
        "_rels/.rels": (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>"),
        "xl/workbook.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{m}" xmlns:r="{_REL_NS}">'
            f'<sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>'),
        "xl/_rels/workbook.xml.rels": (
            '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            "</Relationships>"),
        "xl/worksheets/sheet1.xml": f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{m}"><sheetData>{body}</sheetData></worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in files.items():
            zf.writestr(name, text)
    return buf.getvalue()


def write_partition_files(df: DataFrame, out_dir: str, kind: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``df`` as xlsx workbooks or zip archives of at most ``rows_per_file`` rows (as many
    as that takes for each partition, from the executors) into ``out_dir`` (a shared folder).
    A task that runs again replaces its own files. Returns the number of files written."""
    import csv
    import os
    import uuid

    columns = df.columns

    def save(rows: list, name: str) -> str:
        folder = re.sub("^file:/+", "/", out_dir)  # a mounted shared folder; other stores can't be opened as files
        if re.match("[a-z][a-z0-9+.-]*:/", folder):
            raise ValueError(f"{out_dir}: only a mounted folder can take workbooks and archives")
        os.makedirs(folder, exist_ok=True)
        if kind == "xlsx":
            data = xlsx_bytes(columns, rows)
        else:
            s = io.StringIO()
            w = csv.writer(s, lineterminator="\n")
            w.writerow(columns)
            w.writerows(rows)
            zbuf = io.BytesIO()
            with zipfile.ZipFile(zbuf, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr("export/", "")
                zf.writestr(f"export/{name}.csv", s.getvalue())
                zf.writestr("__MACOSX/export/._meta", "x")
            data = zbuf.getvalue()
        path, part = f"{folder}/{name}.{kind}", f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
        with open(part, "wb") as fh:
            fh.write(data)
        os.replace(part, path)
        return path

    def write(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        names = (f"part-{TaskContext.get().partitionId():06d}-{k:06d}" for k in itertools.count())
        rows: list = []
        for pdf in it:
            rows.extend(pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None))
            while len(rows) >= rows_per_file:
                yield pd.DataFrame({"path": [save(rows[:rows_per_file], next(names))]})
                rows = rows[rows_per_file:]
        if rows:
            yield pd.DataFrame({"path": [save(rows, next(names))]})

    return df.mapInPandas(write, "path string").count()


# The helpers above run inside executor tasks. Ship this module's code by value
# with each task, so executors do not need the package installed or on a path.
def _ship_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
