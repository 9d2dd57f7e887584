"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if hasattr(value, "as_tuple"):
        return _cell(float(value))
    return value


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_result(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def duck_result(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return canonical(cursor.fetchall(), columns)
