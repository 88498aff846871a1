"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from medalstar.sources.samples import INPUT_SCHEMAS


def sql_database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process database with the test tables as views."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in INPUT_SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# SQL type -> Spark types that hold the same values.
_KINDS = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "VARCHAR": {"string"}, "DOUBLE": {"double"}, "BOOLEAN": {"boolean"},
    "DATE": {"date"}, "TIMESTAMP": {"timestamp", "timestamp_ntz"}, "TIMESTAMP WITH TIME ZONE": {"timestamp"},
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, (str(d[1]) for d in result.description)))
    expected = result.fetchall()
    found: list[str] = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    for column, kind in df.dtypes:
        if kind not in _KINDS.get(kinds[column], set()):
            found.append(f"type of {column}: {kind} and {kinds[column]}")
    rows = [tuple(r) for r in df.collect()]
    have, want = _rows(rows, df.columns), _rows(expected, names)
    if have != want:
        found.append(f"{len(rows)} rows, expected {len(expected)}")
        found += [f"only in spark: {r}" for r in list((have - want).elements())[:2]]
        found += [f"only in sql:   {r}" for r in list((want - have).elements())[:2]]
    return found
