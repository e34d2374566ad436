"""Compare queries with their SQL in DuckDB: python -m tests.compare [SF] [NAME...]"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

from quirefold.session import build_session


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return tuple(_cell(v) for v in x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return float(x) if type(x).__name__ == "Decimal" else x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        files = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{files}')")
    return con


def compare(spark, con, name, query, sql, folder):
    df = query(spark, folder)
    got = df.collect()
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    a, b = rows(df.columns, got), rows(cols, want)
    if a == b:
        return ""
    sa, sb = set(map(repr, a)), set(map(repr, b))
    return f"{len(a)} vs {len(b)} rows; only here {[x for x in a if repr(x) not in sb][:3]}; only SQL {[x for x in b if repr(x) not in sa][:3]}"


def main() -> None:
    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder, names = f"/root/testdata/sf{sf}", sys.argv[2:]
    spark, con = build_session(cpus=8), connect(folder)
    qs, sql = e.queries(), e.oracle_sql()
    for n in names or list(qs):
        t = time.time()
        try:
            if n in sql:
                said = compare(spark, con, n, qs[n], sql[n], folder) or f"ok ({len(con.execute(sql[n]).fetchall())} rows)"
            else:
                said = f"rows {qs[n](spark, folder).count()}"
        except Exception as x:  # noqa: BLE001
            said = "ERROR " + str(x)[:1500]
        print(f"{n}: {said} {time.time() - t:.1f}s", flush=True)


if __name__ == "__main__":
    main()
