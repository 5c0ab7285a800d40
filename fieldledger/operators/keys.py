"""Key matching helpers shared by the joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.operators.columns import quoted

PREFIX = "_k_"
SPREAD = 16


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The key columns under names that do not clash with those of another frame."""
    return [quoted(k).alias(PREFIX + k) for k in keys]


def key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``df``, each at most ``SPREAD`` times, as the right side of a semi or anti join.

    Repeats are removed on the map side and a key with very many rows is spread over several tasks.
    The join then shuffles the few rows left on its own, which is the form in which adaptive
    execution can split a hot key of the left side.
    """
    lot = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(SPREAD)).alias("_lot")
    return df.select(*key_columns(df, keys), lot).distinct().drop("_lot")


def keys_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Plain equality on every key, so that null keys never match."""
    return reduce(and_, [left[k] == right[PREFIX + k] for k in keys])
