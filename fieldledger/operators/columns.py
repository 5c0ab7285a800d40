"""Column lists: required columns, clean unique names, ordering."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fieldledger.functions.text import clean_names


def quoted(name: str):
    """Column of exactly this name, dots and dashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(taken: Sequence[str], name: str) -> str:
    """``name``, lengthened until none of the taken names is equal to it; case does not tell names apart."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that lists the missing columns."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    return df


def check_choice(value: str, allowed: Sequence[str], what: str) -> str:
    """``value`` itself, or an error that lists the allowed ones."""
    if value not in allowed:
        raise ValueError(f"Invalid {what} '{value}', use one of: {', '.join(allowed)}")
    return value


def unique_names(cleaned: Sequence[str]) -> list[str]:
    """Names as they are, but those that clash get the next free suffix ``_1``, ``_2``, …"""
    times = Counter(cleaned)
    taken = {name for name in cleaned if times[name] == 1}
    result = []
    for name in cleaned:
        if times[name] > 1:
            number = 1
            while f"{name}_{number}" in taken:
                number += 1
            name = f"{name}_{number}"
            taken.add(name)
        result.append(name)
    return result


def clean_columns(df: DataFrame) -> DataFrame:
    """``df`` with cleaned, unique column names (schema only; no data is read)."""
    return df.toDF(*unique_names(clean_names(df.columns)))


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*[quoted(name) for name in sorted(df.columns)])


def sort_rows(df: DataFrame, within: str | None = None) -> DataFrame:
    """Rows by every column, ascending, nulls first.

    With ``within`` the order holds inside each value of that column, as for files written per
    period: rows are range-partitioned on all columns, that one first, so that a period of any size
    spreads over many tasks. A running number as last range key parts equal rows too.
    """
    names = [c for c in df.columns if c != within]
    order = [quoted(c) for c in ([within] if within else []) + names]
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    if within is None:
        return numbered.orderBy(*order, "_tie").drop("_tie")
    return numbered.repartitionByRange(*order, "_tie").sortWithinPartitions(*order).drop("_tie")
