"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate.

Usage as a script::

    python tests/oracle_check.py [sf_dir] [key ...]

Compares row count, column names, a coarse type per column and the
order-insensitive multiset of rows for each key that has oracle SQL.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _kind_spark(dtype) -> str:
    name = dtype.typeName()
    if name in ("integer", "long", "short", "byte"):
        return "int"
    if name in ("double", "float", "decimal"):
        return "float"
    if name in ("timestamp", "timestamp_ntz"):
        return "timestamp"
    return name


def _kind_duck(tname: str) -> str:
    t = str(tname).upper()
    if t in ("INTEGER", "BIGINT", "SMALLINT", "TINYINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int"
    if t in ("DOUBLE", "FLOAT", "REAL") or t.startswith("DECIMAL"):
        return "float"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    if t == "BOOLEAN":
        return "boolean"
    if t == "DATE":
        return "date"
    return t.lower()


def spark_rows(df):
    cols = sorted(df.columns)
    kinds = {f.name: _kind_spark(f.dataType) for f in df.schema.fields}
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, [kinds[c] for c in cols], rows


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    names = rel.columns
    types = [str(t) for t in rel.types]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    kinds = [_kind_duck(types[i]) for i in order]
    rows = [tuple(_norm(row[i]) for i in order) for row in data]
    return cols, kinds, rows


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_kinds, s_rows = spark_rows(E.queries()[key](spark, sf_dir))
    t1 = time.time()
    d_cols, d_kinds, d_rows = duck_rows(con, E.oracle_sql()[key])
    out = {
        "key": key,
        "rows": (len(s_rows), len(d_rows)),
        "spark_sec": round(t1 - t0, 2),
        "columns_ok": s_cols == d_cols,
        "types_ok": s_kinds == d_kinds,
    }
    if not out["columns_ok"]:
        out["columns"] = (s_cols, d_cols)
    if not out["types_ok"]:
        out["types"] = [(c, a, b) for c, a, b in zip(s_cols, s_kinds, d_kinds) if a != b]
    ss, ds = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    out["values_ok"] = ss == ds
    if not out["values_ok"]:
        diff_s = [r for r in ss if r not in set(ds)][:3] if len(ss) < 20000 else ss[:2]
        diff_d = [r for r in ds if r not in set(ss)][:3] if len(ds) < 20000 else ds[:2]
        out["example"] = {"cols": s_cols, "spark_only": diff_s, "duck_only": diff_d}
    out["ok"] = out["columns_ok"] and out["types_ok"] and out["values_ok"] and out["rows"][0] == out["rows"][1]
    return out


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or sorted(E.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con)
        except Exception as exc:  # noqa: BLE001
            r = {"key": k, "ok": False, "error": repr(exc)[:600]}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + str(r), flush=True)
    missing = sorted(set(E.queries()) - set(E.oracle_sql()))
    print("no oracle (rows-only):", missing)
    print("failures:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
