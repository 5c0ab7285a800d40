"""Wide to long, and unions of frames with different types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldledger.functions.numbers import DECIMAL_PATTERN, is_nan_text, value_to_string, widen_float
from fieldledger.functions.text import is_blank
from fieldledger.operators.columns import quoted


def _explode_values(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per id row and value column: the ids, ``_at`` (index in ``_order``), ``_number``, ``_text``.

    Doubles and texts go into one array each and a position is exploded, so that a test or a format
    is compiled once and not once per column. Forms have hundreds of columns; generated code that
    grows with all of them is soon too long for the JVM to optimise. The arrays are built below the
    explode, hence once per row.
    """
    numbers, _ = _order(df, values)
    exploded = _value_arrays(df, ids, values).select("*", F.explode(positions(values)).alias("_at"))
    number, text = parts(F.col("_at"), len(numbers))
    return exploded.select(*[quoted(c) for c in ids], "_at", number.alias("_number"), text.alias("_text"))


def _value_arrays(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The ids with the value columns as ``_numbers`` and ``_texts``, in the order of ``_order``."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    numbers, texts = _order(df, values)
    doubles = [widen_float(quoted(c)) if isinstance(kinds[c], T.FloatType) else quoted(c) for c in numbers]
    strings = [quoted(c).cast("string") for c in texts]
    return df.select(
        *[quoted(c) for c in ids],
        F.array(*doubles).cast("array<double>").alias("_numbers"),
        F.array(*strings).cast("array<string>").alias("_texts"),
    )


def positions(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in range(len(values))])


def parts(at: Column, n_numbers: int, before: str = "") -> tuple[Column, Column]:
    """Number and text at a position of ``_value_arrays``, whose names may have a prefix."""
    return F.get(f"{before}_numbers", at), F.get(f"{before}_texts", at - n_numbers)


def read_number(number: Column, text: Column) -> Column:
    """The number of a value, or that of its text if it reads as a decimal number."""
    is_decimal = (text.contains(".") | text.contains("e") | text.contains("E")) & text.rlike(DECIMAL_PATTERN)
    return F.when(number.isNotNull(), number).when(is_decimal, text.try_cast("double"))


def value_text(texts_too: bool = False, number: Column | None = None, text: Column | None = None) -> Column:
    """Text of an exploded value; at most one of its two parts is given.

    With ``texts_too``, a text that reads as a decimal number gets the format of a number, so that a value does not
    depend on whether its column was read as numbers or as texts.
    """
    number = F.col("_number") if number is None else number
    text = F.col("_text") if text is None else text
    if texts_too:
        number = read_number(number, text)
    return F.when(number.isNotNull(), value_to_string(number, T.DoubleType())).otherwise(text)


def _order(df: DataFrame, values: Sequence[str]) -> tuple[list[str], list[str]]:
    """Value columns as those of floating-point numbers, then all others."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    numbers = [c for c in values if isinstance(kinds[c], (T.DoubleType, T.FloatType))]
    return numbers, [c for c in values if c not in set(numbers)]


def lookup(items: Sequence[str | None], at: str) -> Column:
    """Item at a position of a constant list."""
    return F.get(F.array(*[F.lit(item).cast("string") for item in items]), F.col(at))


def unpivot_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    variable: str = "data_element",
    value: str = "value",
) -> DataFrame:
    """One row per id row and value column, values as text, nulls kept."""
    names = list(values) if values is not None else [c for c in df.columns if c not in set(ids)]
    if not names:
        empty = F.lit(None).cast("string")
        return df.select(*[quoted(c) for c in ids], empty.alias(variable), empty.alias(value)).where("false")
    numbers, texts = _order(df, names)
    # The value comes out of an explode of one element, so that a later test on it cannot be pushed
    # down into a second evaluation of the formatting.
    return _explode_values(df, ids, names).select(
        *[quoted(c) for c in ids],
        lookup(numbers + texts, "_at").alias(variable),
        F.explode(F.array(value_text())).alias(value),
    )


def _usable_values(df: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Exploded values without those that are null, blank or NaN; they go before numbers are formatted."""
    return _explode_values(df, ids, names).where(usable(F.col("_number"), F.col("_text")))


def usable(number: Column, text: Column) -> Column:
    return (number.isNotNull() & ~F.isnan(number)) | (~is_blank(text) & ~is_nan_text(text))


def unpivot_mapped(
    df: DataFrame, ids: Sequence[str], targets: Sequence[tuple[str, str, str | None]], value: str = "VALUE"
) -> DataFrame:
    """Unpivot and map in one step: one row per id row and target with a usable value.

    ``targets`` holds (column, target id, combination). Only mapped columns are named, so the scan
    reads no other, and the mapping itself needs no join. Values that are null, blank or NaN are
    dropped before numbers are formatted.
    """
    names = [name for name, _, _ in targets]
    numbers, _ = _order(df, names)
    ordered = [t for t in targets if t[0] in set(numbers)] + [t for t in targets if t[0] not in set(numbers)]
    # The format looks at the number several times; as a column of its own it is read from the text once.
    read = read_number(F.col("_number"), F.col("_text")).alias("_read")
    return _usable_values(df, ids, [t[0] for t in ordered]).select("*", read).select(
        *[quoted(c) for c in ids],
        lookup([uid for _, uid, _ in ordered], "_at").alias("DX_UID"),
        lookup([combo for _, _, combo in ordered], "_at").alias("COC"),
        value_text(number=F.col("_read")).alias(value),
    )


def unpivot_packed(
    df: DataFrame, ids: Sequence[str], targets: Sequence[tuple[str, str, str | None]]
) -> tuple[DataFrame, int, list[tuple[str, str | None]]]:
    """What ``unpivot_mapped`` explodes, one row per id row: the ids and ``_numbers`` and ``_texts``, a value per target.

    With it come the number of targets held in ``_numbers``, which stand first, and the (target id, combination) of each
    position. A shuffle of these rows moves ids once per id row and no target at all, and numbers as they are.
    """
    names = [name for name, _, _ in targets]
    numbers, _ = _order(df, names)
    ordered = [t for t in targets if t[0] in set(numbers)] + [t for t in targets if t[0] not in set(numbers)]
    count = len([name for name in names if name in set(numbers)])
    return _value_arrays(df, ids, [t[0] for t in ordered]), count, [(uid, combo) for _, uid, combo in ordered]


def unpivot_joined(
    df: DataFrame, ids: Sequence[str], names: Sequence[str], targets: DataFrame, value: str = "VALUE"
) -> DataFrame:
    """The rows of ``unpivot_mapped`` where targets are too many for the projection: the name is unpivoted and joined.

    ``targets`` has ``name`` (lower case), ``uid`` and ``combo``; a value comes out once per target of its name. Only
    the columns ``names`` are read. Spark broadcasts a small target table and shuffles a large one.
    """
    numbers, texts = _order(df, names)
    lowered = [name.lower() for name in numbers + texts]
    long = _usable_values(df, ids, numbers + texts).select(
        *[quoted(c) for c in ids],
        lookup(lowered, "_at").alias("_name"),
        # Formatted below an explode of one element, so that it is not done again for each target.
        F.explode(F.array(value_text(texts_too=True))).alias(value),
    )
    wanted = targets.select(F.col("name").alias("_target"), F.col("uid").alias("DX_UID"), F.col("combo").alias("COC"))
    return long.join(wanted, long["_name"] == wanted["_target"]).select(*[quoted(c) for c in ids], "DX_UID", "COC", value)


_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """Narrowest type that holds all: null gives way, numbers widen, anything else becomes text."""
    kinds = [kind for kind in kinds if not isinstance(kind, T.NullType)]
    if not kinds:
        return T.StringType()
    if all(kind == kinds[0] for kind in kinds):
        return kinds[0]
    ranks = [_RANK.index(type(kind)) if type(kind) in _RANK else None for kind in kinds]
    if None in ranks:
        return T.StringType()
    if T.FloatType in map(type, kinds) and max(ranks) != _RANK.index(T.FloatType):
        return T.DoubleType()
    if max(ranks) == _RANK.index(T.FloatType) and _RANK.index(T.LongType) in ranks:
        return T.DoubleType()
    return _RANK[max(ranks)]()


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with the same columns, each column widened to a common type."""
    if not frames:
        raise ValueError("union_relaxed needs at least one frame")
    names = frames[0].columns
    for frame in frames[1:]:
        if frame.columns != names:
            raise ValueError(f"Columns differ: {names} and {frame.columns}")
    return union_wide(frames)


def union_wide(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns may differ: all columns, null where a frame has none, each of a common type."""
    own = [{field.name: field.dataType for field in frame.schema.fields} for frame in frames]
    names = list(dict.fromkeys(name for kinds in own for name in kinds))
    common = {name: common_type([kinds[name] for kinds in own if name in kinds]) for name in names}

    def widened(frame: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
        columns = []
        for name in names:
            if name not in kinds:
                col = F.lit(None).cast(common[name])
            elif isinstance(common[name], T.StringType):
                col = value_to_string(quoted(name), kinds[name])
            else:
                col = quoted(name).cast(common[name])
            columns.append(col.alias(name))
        return frame.select(*columns)

    return reduce(DataFrame.unionByName, [widened(f, k) for f, k in zip(frames, own, strict=True)])


# Targets that go into the projection; a larger mapping is joined.
LITERAL_TARGETS = 10_000


def targets_of(mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Targets of the given columns: ``name`` in lower case, ``uid``, ``combo``."""
    names = sorted({name.lower() for name in columns})
    targets = mapping.select(F.lower("name").alias("name"), F.col("data_element_id").alias("uid"), F.col("COC").alias("combo"))
    return targets.where(F.col("name").isin(names) & F.col("uid").isNotNull())


def mapped_columns(targets: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that have a target; the driver sees at most the names of a form's columns."""
    found = {row.name for row in targets.select("name").distinct().collect()}
    return [name for name in columns if name.lower() in found]


def read_targets(
    targets: DataFrame, columns: Sequence[str], most: int = LITERAL_TARGETS
) -> list[tuple[str, str, str | None]] | None:
    """``targets_of`` as a list of (column, target id, combination), or None if there are more than ``most``."""
    rows = targets.limit(most + 1).collect()
    if len(rows) > most:
        return None
    by_name: dict[str, list[str]] = {}
    for name in columns:
        by_name.setdefault(name.lower(), []).append(name)
    found = [(name, row.uid, row.combo) for row in rows for name in by_name[row.name]]
    return sorted(found, key=lambda t: (t[0], t[1], t[2] or ""))
