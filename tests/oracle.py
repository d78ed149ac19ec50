"""Run a query on Spark and its SQL on DuckDB and compare the two results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf, name, fn, sql):
    """None when equal, else a description."""
    df = fn(spark, sf)
    s_names, s_rows = rows_of(df.columns, [tuple(x) for x in df.collect()])
    if sql is None:
        return None if s_rows else "no rows"
    cur = con.execute(sql)
    d_names, d_rows = rows_of([c[0] for c in cur.description], cur.fetchall())
    if s_names != d_names:
        return f"columns {s_names} vs {d_names}"
    if not s_rows:
        return "no rows"
    if len(s_rows) != len(d_rows):
        return f"row counts {len(s_rows)} vs {len(d_rows)}: {s_rows[:3]} vs {d_rows[:3]}"
    kinds = [(type(a), type(b)) for a, b in zip(s_rows[0], d_rows[0]) if type(a) is not type(b) and None not in (a, b)]
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        return f"{len(bad)} rows differ of {len(s_rows)}; {s_names}; first {bad[0][0]} vs {bad[0][1]}"
    return f"types differ {kinds}" if kinds else None


if __name__ == "__main__":
    from millrace import build_session
    from millrace.catalog import ORACLE, QUERIES

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false"})
    con = connect(sf)
    failures = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, sf, name, fn, ORACLE.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {'' if name in ORACLE else '(rows only)'} {problem or ''}", flush=True)
    print("failures", failures, "of", len(QUERIES), "with sql", len(ORACLE))
