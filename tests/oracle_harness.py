"""Run registered Spark queries next to their DuckDB oracle and compare.

Compares row count, column names and type families, and the multiset of rows
(columns sorted by name, floats compared to 1e-9 relative). Usable from pytest
and as a script: ``python tests/oracle_harness.py /root/testdata/sf0.01 [names]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from alloy.sources.tables import TABLES, table_path  # noqa: E402

_FAMILY = {
    "LongType": "int64", "BIGINT": "int64",
    "IntegerType": "int32", "INTEGER": "int32",
    "DoubleType": "float64", "DOUBLE": "float64",
    "FloatType": "float32", "FLOAT": "float32",
    "StringType": "string", "VARCHAR": "string",
    "BooleanType": "bool", "BOOLEAN": "bool",
    "TimestampType": "timestamp", "TIMESTAMP": "timestamp", "TimestampNTZType": "timestamp",
    "DateType": "date", "DATE": "date",
}


def _spark_type(t) -> str:
    return f"{_spark_type(t.elementType)}[]" if type(t).__name__ == "ArrayType" else type(t).__name__


def _family(t: str) -> str:
    return f"{_family(t[:-2])}[]" if t.endswith("[]") else _FAMILY.get(t, t)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


EXACT = bool(os.environ.get("ORACLE_EXACT"))


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):  # arrays and rows
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(_norm(x) for x in v.values())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_types = [_spark_type(f.dataType) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = entry.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    sf = dict(zip(s_cols, map(_family, s_types)))
    df_ = dict(zip(d_cols, map(_family, d_types)))
    res["types_match"] = sf == df_
    if not res["types_match"]:
        res["types"] = {"spark": sf, "duckdb": df_}
    if not res["cols_match"]:
        res["columns"] = {"spark": s_cols, "duckdb": d_cols}
    sr, dr = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = sr == dr
    if not res["values_match"]:
        res["only_spark"] = list((sr - dr).elements())[:3]
        res["only_duckdb"] = list((dr - sr).elements())[:3]
    res["ok"] = res["cols_match"] and res["types_match"] and res["values_match"]
    return res


if __name__ == "__main__":
    from alloy.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        if not r.get("ok", r.get("oracle") == "none"):
            bad += 1
        print(r, flush=True)
    print(f"failed: {bad} of {len(names)}")
