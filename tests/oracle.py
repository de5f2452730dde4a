"""Spark-vs-DuckDB comparison in the way the driver checks queries:
column names, row count and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def rows_signature(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(norm).encode()).hexdigest()
    return [columns[i] for i in order], len(norm), h, norm


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sn, sh, snorm = rows_signature(s_cols, s_rows)
    dc, dn, dh, dnorm = rows_signature(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns spark={sc} duck={dc}")
    if sn != dn:
        problems.append(f"rows spark={sn} duck={dn}")
    if sh != dh and sc == dc:
        only_s = sorted(set(snorm) - set(dnorm))[:3]
        only_d = sorted(set(dnorm) - set(snorm))[:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems
