"""Compare a Spark DataFrame with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], sorted(rows)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], sorted(rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return f"columns differ: spark={sc} sql={dc}"
    if len(sr) != len(dr):
        return f"row count: spark={len(sr)} sql={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"first diff: spark={a} sql={b}"
    return None
