"""Compare each registered Spark query with its DuckDB oracle (exact, order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(canon(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    data = rel.fetchall()
    idx = [rel.columns.index(c) for c in cols]
    return cols, sorted(tuple(canon(r[i]) for i in idx) for r in data)


def compare(spark, name, query, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    sc, sr = spark_rows(query(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark-only {sorted(set(sc) - set(dc))} duck-only {sorted(set(dc) - set(sc))}"
    if len(sr) != len(dr):
        return False, f"row count {len(sr)} vs {len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
        return False, f"{len(bad)} rows differ; first: {diff[:6]}"
    return True, f"{len(sr)} rows"
