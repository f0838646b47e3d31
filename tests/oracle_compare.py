"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duckdb(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    names = list(rel.columns)
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    data = rel.fetchall()
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=repr)


def assert_same(df, sql: str, sf_dir: str):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duckdb(sql, sf_dir)
    assert sc == dc, f"columns differ: {sc} vs {dc}"
    assert len(sr) == len(dr), f"row counts differ: {len(sr)} vs {len(dr)}"
    for a, b in zip(sr, dr):
        assert a == b, f"first differing row:\n spark {a}\n duck  {b}"
