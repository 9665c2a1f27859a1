"""Comparing a query's rows with those of its SQL on the same tables."""

import math
import os
from pathlib import Path

import duckdb

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir=SF_DIR):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)


def in_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def expected(connection, sql):
    cursor = connection.execute(sql)
    return in_order([d[0] for d in cursor.description], cursor.fetchall())


def actual(df):
    return in_order(df.columns, [tuple(r) for r in df.collect()])
