"""Spark query vs DuckDB oracle: row count, column names and an
order-insensitive comparison of the values (the driver's gate)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("0null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", repr(float(v)))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", repr(float(v))) if abs(v) < 2**53 else ("int", v)
    if isinstance(v, decimal.Decimal):
        return ("num", repr(float(v)))
    if isinstance(v, _dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, _dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    return ("str", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols, "oracle_cols": d_cols,
    }
    sr, dr = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["values_match"] = out["columns_match"] and sr == dr
    if not out["values_match"] and out["columns_match"]:
        ss, ds = set(sr), set(dr)
        out["only_spark"] = sorted(ss - ds)[:3]
        out["only_oracle"] = sorted(ds - ss)[:3]
    return out
