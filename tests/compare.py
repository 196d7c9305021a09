"""Side-by-side comparison of a Spark query and its DuckDB SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    return str(v)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def differences(a, b) -> str | None:
    (ca, ra), (cb, rb) = a, b
    if ca != cb:
        return f"columns {ca} != {cb}"
    if len(ra) != len(rb):
        only = [r for r in ra if r not in set(rb)][:2], [r for r in rb if r not in set(ra)][:2]
        return f"rows {len(ra)} != {len(rb)} {only}"
    bad = [(x, y) for x, y in zip(ra, rb) if x != y]
    return f"{len(bad)} of {len(ra)} rows differ, e.g. {bad[0]}" if bad else None
