"""Compare a registered Spark query with its DuckDB oracle on the same tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from tillroll.sources.model import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    problems = []
    wrong = {c: (t, d_types.get(c)) for c, t in s_types.items()
             if SPARK_TO_DUCK.get(t, t) != d_types.get(c)}
    if wrong:
        problems.append(f"types differ: {wrong}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(d_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        problems.append(f"{len(diff)} rows differ; first: {diff[:2]} cols={sorted(s_cols)}")
    return problems
