"""Compare a Spark result with SQL over the same tables: columns, types and rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        return repr(float(value))
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None; also None only if there is at least one row."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    kinds = {d[0]: str(d[1]) for d in want.description}
    expected = rows(names, want.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    wrong = {n: (k, kinds[n]) for n, k in df.dtypes if TYPES.get(k, k) != kinds[n]}
    got = rows(df.columns, df.collect())
    if not got:
        return "no rows"
    if got != expected:
        more, fewer = got - expected, expected - got
        return (
            f"{got.total()} rows instead of {expected.total()}; columns {sorted(names)}\n"
            f"only here ({more.total()}): {list(more)[:3]}\nonly there ({fewer.total()}): {list(fewer)[:3]}"
        )
    return f"types {wrong}" if wrong else None
