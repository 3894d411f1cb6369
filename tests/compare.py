"""Run a registered query and its SQL on the same Parquet tables and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

# What DuckDB calls the types that Spark results have.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What sets the Spark result and the SQL result apart; empty when they agree."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    names = [d[0] for d in described]
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    types = {d[0]: d[1] for d in described}
    for name, dtype in df.dtypes:
        if SAME_TYPE.get(dtype) != types[name]:
            found.append(f"type of {name}: {dtype} against {types[name]}")
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(names, con.execute(sql).fetchall())
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    unlike = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if unlike:
        found.append(f"{len(unlike)} rows differ, first {unlike[0]}")
    return found
