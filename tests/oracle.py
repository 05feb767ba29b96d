"""Compares a query with its oracle SQL in DuckDB, rows in any order."""

import datetime
import decimal

import duckdb

from quillon.plans.domain import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([canonical(v) for v in value])
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in data), key=lambda r: tuple((v is None, str(v)) for v in r))
