"""Rows of a Spark result against rows of DuckDB's."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(table):
    names = sorted(table.column_names)
    got = [tuple(plain(v) for v in r) for r in zip(*[table.column(n).to_pylist() for n in names])]
    return names, sorted(got, key=lambda r: [(v is None, str(v)) for v in r])


def oracle(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con.sql(sql).to_arrow_table()
