"""Spark-vs-DuckDB comparison used by the tests and by ``check_oracle.py``.

Mirrors the driver's gate: same column names, same row count, and the same
order-insensitive multiset of rows (doubles compared after rounding).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v, digits=6):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        r = round(v, digits)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item(), digits)
    return str(v)


def canon_rows(cols, rows, digits=6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_canon(r[i], digits) for i in order) for r in rows)
    return [cols[i] for i in order], out


def compare(spark, name, fn, sql, sf_dir, con=None, digits=6):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = canon_rows(s_cols, s_rows, digits)
    dc, dr = canon_rows(d_cols, d_rows, digits)
    report = {"name": name, "spark_rows": len(sr), "oracle_rows": len(dr),
              "cols_match": sc == dc, "values_match": sr == dr}
    if sc != dc:
        report["spark_cols"], report["oracle_cols"] = sc, dc
    elif sr != dr:
        ss, ds = set(sr), set(dr)
        report["only_spark"] = sorted(ss - ds)[:3]
        report["only_oracle"] = sorted(ds - ss)[:3]
    report["ok"] = report["cols_match"] and report["values_match"]
    return report
