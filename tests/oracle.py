"""Compares a query's rows with DuckDB's, columns by name, rows in any order."""

import math
import os

import duckdb

from scrivena.plans.fixtures import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def rows_of_sql(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = sorted(rel.columns)
    at = [rel.columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
