"""Runs a query and its SQL and compares the rows, columns by name, without regard to order."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        c.sql(f"create view {t} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return x


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def both(spark, sf_dir: str, query, sql: str):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    want = connect(sf_dir).sql(sql)
    return (sorted(df.columns), got), (sorted(want.columns), rows(want.columns, want.fetchall()))
