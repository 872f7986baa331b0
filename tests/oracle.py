"""Side-by-side comparison of a query with its SQL oracle."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, folder, connection, function, sql) -> list[str]:
    """Differences in columns, row count or values; empty when equal."""
    frame = function(spark, folder)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    found = connection.execute(sql)
    theirs = _rows([d[0] for d in found.description], found.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} vs {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        problems = [f"rows {len(ours[1])} vs {len(theirs[1])}"]
    else:
        problems = []
    here, there = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    if here or there:
        problems.append(f"{len(here)} only in Spark, {len(there)} only in SQL: {sorted(here)[:2]} / {sorted(there)[:2]}")
    return problems
