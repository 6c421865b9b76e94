"""Comparison of a query's rows with those of its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value


def rows_of_query(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(map(_plain, r)) for r in df.select(*columns).collect()), key=repr)


def rows_of_sql(sql, sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
