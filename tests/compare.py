"""Rows of a DataFrame against rows of DuckDB SQL on the same tables."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)


def rows_of_sql(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.sql(sql)
    names = list(found.columns)
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
