"""Compare registered queries with their SQL in DuckDB: columns, row count, values in any order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

from kpiweave.plans.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return repr(value) if isinstance(value, bool) or value is None else str(value)


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows; "
        f"only spark {sum(only_ours.values())}: {list(only_ours)[:3]}; "
        f"only sql {sum(only_theirs.values())}: {list(only_theirs)[:3]}"
    )
