"""Compare a Spark result with DuckDB's as multisets of rows, columns in name order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(frame, connection, sql: str) -> tuple[str, int]:
    """An empty text and the row count if both agree, else a text that says how they differ."""
    names, got = _sorted(frame.columns, frame.collect())
    result = connection.execute(sql)
    oracle_names, want = _sorted([d[0] for d in result.description], result.fetchall())
    if names != oracle_names:
        return f"columns {names} != {oracle_names}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"{len(differing)} of {len(got)} rows differ, first {differing[0]}", len(got)
    return "", len(got)
