"""Compare a registered query with its SQL, row by row and without regard to order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(df, connection, sql: str) -> list[str]:
    """Empty if columns, their types, the number of rows and all values agree."""
    result = connection.execute(sql)
    types = {column[0]: str(column[1]) for column in result.description}
    other = {n: (t, types[n]) for n, t in df.dtypes if n in types and SAME_TYPE.get(t) != types[n]}
    if other:
        return [f"types: {other}"]
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns: {sorted(set(names) ^ set(df.columns))}"]
    expected = _sorted_rows(names, result.fetchall())
    found = _sorted_rows(df.columns, df.collect())
    if len(expected) != len(found):
        return [f"rows: {len(found)} found, {len(expected)} expected"]
    wrong = [(f, e) for f, e in zip(found, expected) if f != e or list(map(type, f)) != list(map(type, e))]
    return [f"{len(wrong)} of {len(found)} rows differ, e.g.\n  found    {wrong[0][0]}\n  expected {wrong[0][1]}"] if wrong else []
