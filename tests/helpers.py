"""Comparison of Spark rows with DuckDB rows, order ignored."""

import datetime
import decimal
import math

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)):
        return f"{float(x):.7g}"
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)[:10]
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


def duck(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{DATA}/{sf}/{t}.parquet'")
    out = con.execute(sql)
    columns = [d[0] for d in out.description]
    return sorted(columns), rows_of(columns, out.fetchall())


def sparked(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())
