"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from urbanlens.session import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date, dt.time)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))
    return cols, out


_SPARK_KIND = (("tinyint", "int8"), ("smallint", "int16"), ("bigint", "int64"), ("int", "int32"),
               ("double", "float64"), ("float", "float32"), ("string", "str"), ("timestamp", "ts"),
               ("date", "date"), ("boolean", "bool"))
_DUCK_KIND = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "HUGEINT": "int128",
              "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "str", "DATE": "date", "BOOLEAN": "bool",
              "TIMESTAMP": "ts"}


def _spark_kind(t) -> str:
    s = t.simpleString()
    if s.startswith("decimal"):
        return s
    return next((v for k, v in _SPARK_KIND if s.startswith(k)), s)


def _duck_kind(t) -> str:
    s = str(t).upper()
    return "decimal" + s[7:].lower().replace(" ", "") if s.startswith("DECIMAL") else _DUCK_KIND.get(s, s)


def compare(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> dict:
    s_cols, s_rows = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_types = {n: _duck_kind(t) for n, t in zip(rel.columns, rel.types)}
    s_types = {f.name: _spark_kind(f.dataType) for f in spark_df.schema.fields}
    cur = con.execute(sql)
    d_cols_raw = [d[0] for d in cur.description]
    d_cols, d_rows = _rows(d_cols_raw, cur.fetchall())
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "types_match": s_types == d_types,
           "values_match": s_rows == d_rows}
    if not res["types_match"]:
        res["type_diff"] = {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types)
                            if s_types.get(k) != d_types.get(k)}
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    elif not res["values_match"]:
        s_set, d_set = set(s_rows), set(d_rows)
        res["only_spark"] = sorted(s_set - d_set, key=str)[:3]
        res["only_oracle"] = sorted(d_set - s_set, key=str)[:3]
    res["ok"] = res["columns_match"] and res["values_match"] and res["types_match"]
    return res
