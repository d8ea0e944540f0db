"""Run registered queries next to their SQL twins and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """One spelling per value, whatever the engine's type."""
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v else "0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(Decimal(repr(round(v, 6))).normalize(), "f") if v else "0"
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql: str) -> dict:
    theirs = {r[0]: r[1] for r in con.execute("describe " + sql).fetchall()}
    return {c: (t, theirs.get(c)) for c, t in df.dtypes if SQL_TYPES.get(t, t.upper()) != theirs.get(c)}


def check(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t = time.time()
    df = queries()[name](spark, sf_dir)
    left = rows(df.columns, df.collect())
    seconds = time.time() - t
    sql = oracle_sql().get(name)
    if sql is None:
        return {"name": name, "ok": True, "rows": len(left), "seconds": seconds, "twin": False}
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = rows(names, cur.fetchall())
    types = type_differences(df, con, sql)
    ok = sorted(names) == sorted(df.columns) and left == right and not types
    out = {"name": name, "ok": ok, "types": types, "rows": len(left), "twin_rows": len(right), "seconds": seconds, "twin": True}
    if not ok:
        out["columns"] = (sorted(df.columns), sorted(names))
        out["left_only"] = sorted(set(left) - set(right))[:3]
        out["right_only"] = sorted(set(right) - set(left))[:3]
    return out


if __name__ == "__main__":
    from __spark_entry__ import queries
    from ledgerlake.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    session = build_session("compare", 8)
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    bad = 0
    for q in only or queries():
        try:
            r = check(session, db, q, sf)
        except Exception as e:  # report and go on
            r = {"name": q, "ok": False, "error": str(e)[:1500]}
        bad += not r["ok"]
        print(f"{'ok ' if r['ok'] else 'BAD'} {r}" if not r["ok"] else f"ok  {q} rows={r['rows']} {r['seconds']:.2f}s", flush=True)
    print("bad:", bad)
