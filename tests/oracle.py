"""Run a registered query on Spark and its SQL on DuckDB, and compare all rows."""

import datetime as dt
import math
import os
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def duck_rows(folder, sql):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from read_parquet('{path}')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return columns, normal(columns, cursor.fetchall()), types


def spark_rows(df):
    return df.columns, normal(df.columns, [tuple(r) for r in df.collect()])


# DuckDB type -> Spark types it may stand beside.
SAME = {"BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "VARCHAR": {"string"}, "BOOLEAN": {"boolean"}}


def compare(name, df, folder, sql):
    want_cols, want, types = duck_rows(folder, sql)
    got_cols, got = spark_rows(df)
    assert sorted(want_cols) == sorted(got_cols), f"{name}: columns {sorted(got_cols)} vs {sorted(want_cols)}"
    assert len(got) == len(want), f"{name}: {len(got)} rows vs {len(want)}"
    for a, b in zip(got, want):
        assert a == b, f"{name}: {sorted(got_cols)}\n spark {a}\n duck  {b}"
    for column, kind in df.dtypes:
        assert kind in SAME.get(types[column], set()), f"{name}.{column}: {kind} vs {types[column]}"
    return len(got)
