"""Spark result against DuckDB result, as multisets of values by column name."""

import math
import os

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{sf_dir}/{t}'")
    return con


def _value(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in data)


def assert_same(df, con, sql):
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(cur.fetchall(), cols)
