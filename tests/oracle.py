"""Run a registered query and its SQL equivalent, and compare them as bags of rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "smallint": "SMALLINT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(rows, order):
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if both agree on columns, types and values; otherwise what differs."""
    result = con.execute(sql)
    theirs = [(d[0], str(d[1])) for d in result.description]
    expected = result.fetchall()
    ours = [(n, FAMILY.get(t, t)) for n, t in df.dtypes]
    if sorted(ours) != sorted(theirs):
        return f"schema: ours {sorted(ours)} theirs {sorted(theirs)}"
    names = [n for n, _ in ours]
    rows = df.collect()
    left = _bag(rows, [names.index(n) for n in sorted(names)])
    right = _bag(expected, [[n for n, _ in theirs].index(n) for n in sorted(names)])
    if len(left) != len(right):
        return f"rows: ours {len(left)} theirs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"value: ours {str(a)[:300]} theirs {str(b)[:300]}"
    return None
