"""Compare a registered query with its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql):
    """Problems found, empty when rows, column names and values agree exactly."""
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if got_names != want_names:
        problems.append(f"columns {got_names} != {want_names}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    types = [(n, type(g), type(w)) for n, g, w in zip(got_names, *(x[0] for x in (got, want)))
             if type(g) is not type(w)] if got and want else []
    if types:
        problems.append(f"types differ: {types}")
    return problems
