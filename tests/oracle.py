"""Compare a query with its SQL in DuckDB: columns, types, row count and sorted values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "varchar": "VARCHAR"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert that both sides agree; the number of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).upper() for d in result.description}
    expected = result.fetchall()
    got = [tuple(row) for row in df.collect()]
    assert sorted(df.columns) == sorted(names)
    for name, kind in df.dtypes:
        assert TYPES[kind.split("(")[0]] == types[name], (name, kind, types[name])
    assert len(got) == len(expected)
    assert _rows(df.columns, got) == _rows(names, expected)
    return len(got)
