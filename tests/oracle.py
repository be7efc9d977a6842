"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

from tessera.sources.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(normalise(x) for x in v)
    return v


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normalise(r[i]) for i in order) for r in records), key=repr)


def compare(sdf, con, sql):
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols), (s_cols, d_cols)
    assert len(s_rows) == len(d_rows)
    assert canonical(s_cols, s_rows) == canonical(d_cols, d_rows)
    return len(s_rows)
