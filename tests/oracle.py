"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        return f"{float(value):.6g}" if abs(float(value)) > 1e9 else round(float(value), 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr), sorted(names)


def compare(con, df, sql):
    """(equal, message) of a DataFrame against SQL."""
    spark_rows, spark_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    sql_rows, sql_cols = rows_of([d[0] for d in res.description], res.fetchall())
    if spark_cols != sql_cols:
        return False, f"columns {spark_cols} <> {sql_cols}"
    if spark_rows != sql_rows:
        a, b = [r for r in spark_rows if r not in set(sql_rows)], [r for r in sql_rows if r not in set(spark_rows)]
        return False, f"{len(spark_rows)} vs {len(sql_rows)} rows; only spark {a[:3]}; only sql {b[:3]}"
    kinds = {c: {type(r[i]).__name__ for r in spark_rows} ^ {type(r[i]).__name__ for r in sql_rows}
             for i, c in enumerate(spark_cols)}
    kinds = {c: k for c, k in kinds.items() if k}
    return not kinds, f"{len(spark_rows)} rows {kinds or ''}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
    from conftest import session
    from snapgate.suite import catalog

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/sf{sf}"
    spark, con = session(), connect(sf_dir)
    sqls, bad = catalog.oracle_sql(), 0
    for name, fn in catalog.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            ok, msg = compare(con, fn(spark, sf_dir), sqls[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - start:6.2f}s {name}: {msg}", flush=True)
    print("failed:", bad)
