"""Runs a query in Spark and its twin in DuckDB and compares sorted rows."""

import math
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def connection(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in df.collect()), names


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    names = sorted(columns)
    return sorted(tuple(plain(r[columns.index(n)]) for n in names) for r in cur.fetchall()), names
