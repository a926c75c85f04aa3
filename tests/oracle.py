"""Comparison of a Spark result with DuckDB's for the same tables."""

import decimal
import math
import os

import duckdb


def connection(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"create view {name.split('.')[0]} as select * from '{folder}/{name}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def table(rows, columns):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(frame, con, sql):
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(frame.columns)
    want, have = table(got.fetchall(), columns), table(frame.collect(), frame.columns)
    assert len(want) == len(have)
    assert want == have
