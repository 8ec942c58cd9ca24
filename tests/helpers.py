"""Comparing rows across engines, and small frames."""

import datetime as dt

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def day(text):
    return dt.date.fromisoformat(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def same_as_oracle(df, con, sql):
    found = con.sql(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    expected = sorted(repr([r[names.index(c)] for c in order]) for r in found.fetchall())
    actual = sorted(repr([r[c] for c in order]) for r in df.collect())
    assert len(actual) == len(expected)
    assert actual == expected
