"""Compare queries with their SQL in DuckDB, as sorted rows by sorted column names."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str):
    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(x) -> str:
    return f"{x:.6g}" if isinstance(x, float) else str(x)


def sql_rows(c, sql: str):
    done = c.execute(sql)
    names = [d[0] for d in done.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in done.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(x) for x in r) for r in df.select(*(f"`{n}`" for n in names)).collect())
