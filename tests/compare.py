"""Comparing a Spark result with DuckDB's answer, order and number types aside."""

import math
import os

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        path = os.path.join(sf_dir, f)
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    return con


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 9)
    return str(v)


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(value(t[i]) for i in order) for t in tuples), key=repr)


def assert_same(df, con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, found.fetchall())
