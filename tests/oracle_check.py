"""Compare registered Spark queries with their DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Per key: row count, column names + types, and the multiset of rows (column
order sorted by name) must agree.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import json
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, order, rows):
    idx = [names.index(n) for n in order]
    return collections.Counter(tuple(_norm(r[i]) for i in idx) for r in rows)


def compare(spark, key, query, sql, sf_dir, con=None):
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_names = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["names_ok"] = sorted(s_names) == sorted(d_names)
    if out["names_ok"]:
        st = dict(zip(s_names, s_types))
        dtp = dict(zip(d_names, d_types))
        bad = {n: (st[n], dtp[n]) for n in s_names
               if SPARK_TO_DUCK.get(st[n], st[n].upper()) != dtp[n]}
        out["types_ok"] = not bad
        if bad:
            out["type_diff"] = bad
        order = sorted(s_names)
        sc, dc = _rows(s_names, order, s_rows), _rows(d_names, order, d_rows)
        out["values_ok"] = sc == dc
        if not out["values_ok"]:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            out["only_spark"] = [str(x) for x in only_s]
            out["only_oracle"] = [str(x) for x in only_d]
    else:
        out["spark_cols"], out["oracle_cols"] = s_names, d_names
    out["ok"] = bool(out.get("names_ok") and out.get("types_ok") and out.get("values_ok")
                     and out["spark_rows"] == out["oracle_rows"])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from transitlens.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = []
    for key in keys or list(qs):
        if key not in oracles:
            df = qs[key](spark, sf_dir)
            results.append({"key": key, "rows_only": df.count()})
        else:
            try:
                results.append(compare(spark, key, qs[key], oracles[key], sf_dir, con))
            except Exception as exc:  # report and continue with the next key
                results.append({"key": key, "ok": False, "error": repr(exc)[:600]})
        print(json.dumps(results[-1], default=str), flush=True)
    bad = [r["key"] for r in results if r.get("ok") is False]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
