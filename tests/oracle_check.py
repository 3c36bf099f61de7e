"""Compares a query with its reference SQL, value by value."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def spark_table(df):
    return table_of(df.columns, [tuple(row) for row in df.collect()])


def oracle_table(connection, text):
    relation = connection.execute(text)
    columns = [column[0] for column in relation.description]
    return table_of(columns, relation.fetchall())


def difference(left, right):
    """None when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    different = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if different:
        return f"{len(different)} of {len(left[1])} rows differ, first {different[0]}"
    return None
