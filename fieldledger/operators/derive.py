"""Columns derived from form answers: sums, halves and yes/no indicators."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.functions.numbers import to_double, value_to_string
from fieldledger.operators.columns import quoted, require_columns
from fieldledger.settings import Derivations


def sum_name(columns: list[str]) -> str:
    return "_plus_".join(columns)


def half_name(column: str) -> str:
    return f"{column}_divide_2"


def null_sum(columns: list[str], lenient: bool = False) -> Column:
    """Sum as double; one null makes it null."""
    return reduce(add, [to_double(quoted(name), lenient) for name in columns])


def yes_no(text: Column, true_values=("1", "yes"), false_values=("0", "no")) -> Column:
    """1, 0 or null for an answer given as text; case matters."""
    return F.when(text.isin(*true_values), 1).when(text.isin(*false_values), 0)


def derive(df: DataFrame, form: Derivations, lenient: bool = False) -> DataFrame:
    """Add every derived column of ``form`` in one projection.

    Text that is not a number raises, or gives null when ``lenient``.
    """
    used = {name for group in form.sums for name in group} | set(form.halves)
    require_columns(df, sorted(used | {name for name, _ in form.flags}))
    kinds = {field.name: field.dataType for field in df.schema.fields}
    added = [null_sum(group, lenient).alias(sum_name(group)) for group in form.sums]
    added += [(to_double(quoted(name), lenient) / 2).alias(half_name(name)) for name in form.halves]
    added += [
        yes_no(value_to_string(quoted(name), kinds[name]), form.true_values, form.false_values).alias(alias)
        for name, alias in form.flags
    ]
    return df.select("*", *added)
