"""Run ``queries()`` against ``oracle_sql()`` in DuckDB and compare results.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and the order-insensitive multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from farelane.sources.adapters import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("n", repr(float(v)))
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, (int, Decimal)):
        return ("n", repr(float(v)) if isinstance(v, Decimal) else str(v))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", str(v))


def _spark_class(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "bigint"):
        return "int" if t != "bigint" else "bigint"
    if t in ("float", "double"):
        return "double"
    if t.startswith("decimal"):
        return "decimal"
    if t == "timestamp_ntz" or t == "timestamp":
        return "timestamp"
    return {"string": "string", "date": "date", "boolean": "bool"}.get(t, t)


def _duck_class(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "UTINYINT", "USMALLINT", "UINTEGER"):
        return "int"
    if t in ("BIGINT", "UBIGINT", "HUGEINT"):
        return "bigint" if t == "BIGINT" else t.lower()
    if t in ("DOUBLE", "FLOAT"):
        return "double"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "DATE": "date", "BOOLEAN": "bool"}.get(t, t.lower())


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, key: str, sf_dir: str) -> dict:
    q = E.queries()[key]
    sql = E.oracle_sql().get(key)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: _duck_class(str(c[1])) for c in cur.description}
    d_rows = cur.fetchall()
    s_types = {f.name: _spark_class(f.dataType.simpleString()) for f in sdf.schema.fields}
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    if bad_types:
        res["types"] = str(bad_types)[:400]
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_set = sorted(tuple(_norm(r[i]) for i in order) for r in s_rows)
    d_set = sorted(tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    if len(s_rows) != len(d_rows):
        res["status"] = "ROWCOUNT"
    elif s_set != d_set:
        diff = [(a, b) for a, b in zip(s_set, d_set) if a != b][:3]
        res["status"] = "VALUES"
        res["diff"] = str(diff)[:600]
    else:
        res["status"] = "ok" if "types" not in res else "TYPES"
    return res


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")] or list(E.queries())
    from farelane.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(json.dumps(r), flush=True)
    print(json.dumps({"failed": bad, "total": len(keys)}))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
