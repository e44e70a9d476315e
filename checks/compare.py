"""Run a query and its oracle on the same tables and compare the multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone='UTC'")
    for name in TABLE_NAMES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir: str, query, sql: str) -> tuple[int, list[str]]:
    """Rows of the query, and what differs from the oracle."""
    result = query(spark, sf_dir)
    mine = _multiset(result.columns, [tuple(r) for r in result.collect()])
    cursor = connect(sf_dir).execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _multiset(columns, cursor.fetchall())
    found = []
    if sorted(columns) != sorted(result.columns):
        found.append(f"columns {sorted(result.columns)} / {sorted(columns)}")
    elif mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        found.append(
            f"{sum(mine.values())} / {sum(theirs.values())} rows; only here "
            f"{list(extra)[:2]}; only there {list(missing)[:2]}"
        )
    return sum(mine.values()), found
