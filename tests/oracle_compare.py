"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    kinds = {d[0]: str(d[1]) for d in cur.description}
    a, b = _rows(df.columns, got), _rows(names, want)
    result = {
        "spark_rows": len(a),
        "oracle_rows": len(b),
        "columns_equal": sorted(df.columns) == sorted(names),
        "values_equal": a == b,
        "spark_sec": round(t1 - t0, 2),
        "duck_sec": round(time.time() - t1, 2),
    }
    if not result["columns_equal"]:
        result["columns"] = (sorted(set(df.columns) ^ set(names)))
    elif a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        result["differ"] = (len(only_a), len(only_b))
        cols = sorted(names)
        for x, y in list(zip(only_a, only_b))[:2]:
            result.setdefault("sample", []).append([(c, p, q) for c, p, q in zip(cols, x, y) if p != q])
        result["first"] = (only_a[:1], only_b[:1])
    types = {c: t for c, t in df.dtypes}
    same = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    result["types_differ"] = [(c, types[c], kinds.get(c)) for c in types if same.get(types[c]) != kinds.get(c)]
    return result


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as E
    from spanledger.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    sqls = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, fn, sqls[name], sf_dir)
        except Exception as e:
            r = {"error": str(e)[:1500], "values_equal": False}
        ok = r["values_equal"] and not r.get("types_differ") and r.get("spark_rows")
        bad += not ok
        print("OK  " if ok else "FAIL", name, r if not ok else (r["spark_rows"], r["spark_sec"], r["duck_sec"]), flush=True)
    print("failures:", bad)
