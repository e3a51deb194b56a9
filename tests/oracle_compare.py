"""Spark-vs-DuckDB comparison used by the tests and runnable by hand:

    python tests/oracle_compare.py [sf_dir] [query ...]

Compares column names, a coarse type family per column, row count and
the multiset of rows (values rendered canonically, floats exactly).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slaflow.sources.tables import DRIVER_TABLES  # noqa: E402


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return repr(v)


def _family(type_name: str) -> str:
    t = type_name.lower()
    for key, fam in [
        ("bigint", "int64"),
        ("int64", "int64"),
        ("long", "int64"),
        ("hugeint", "int128"),
        ("integer", "int32"),
        ("int32", "int32"),
        ("int", "int32"),
        ("double", "float64"),
        ("float", "float64"),
        ("bool", "bool"),
        ("varchar", "string"),
        ("string", "string"),
        ("timestamp", "timestamp"),
        ("date", "date"),
    ]:
        if key in t:
            return fam
    return t


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_types = {f.name: _family(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = {d[0]: _family(str(d[1])) for d in rel.description}
    d_rows = rel.fetchall()
    s_cols = list(s_types)
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["types_match"] = out["columns_match"] and all(s_types[c] == d_types[c] for c in s_cols)
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_cols) | set(d_cols) if s_types.get(c) != d_types.get(c)}
    if out["columns_match"]:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        s_canon = sorted(tuple(_canon(r[i]) for i in si) for r in s_rows)
        d_canon = sorted(tuple(_canon(r[i]) for i in di) for r in d_rows)
        out["values_match"] = s_canon == d_canon
        if not out["values_match"]:
            s_set, d_set = set(s_canon), set(d_canon)
            out["only_spark"] = [dict(zip(order, r)) for r in sorted(s_set - d_set)[:3]]
            out["only_oracle"] = [dict(zip(order, r)) for r in sorted(d_set - s_set)[:3]]
    else:
        out["values_match"] = False
        out["column_diff"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
    out["ok"] = out["types_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from slaflow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"{n}: no oracle")
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as e:  # report and continue
            print(f"{n}: ERROR {type(e).__name__}: {str(e)[:500]}")
            bad += 1
            continue
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + " ".join(f"{k}={v}" for k, v in r.items()), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
