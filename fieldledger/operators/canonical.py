"""Long answers to canonical points: mapping, defaults and data-quality filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.functions.numbers import is_nan_text
from fieldledger.functions.periods import drop_future
from fieldledger.functions.text import is_blank, is_missing
from fieldledger.operators.columns import quoted, require_columns
from fieldledger.schemas import POINT
from fieldledger.settings import PointRules


def map_names(
    long: DataFrame, mapping: DataFrame, name: str = "data_element", how: str = "left"
) -> DataFrame:
    """Join answers to their targets on the name in lower case; one name may have many targets.

    Join strategy is left to Spark: a mapping below the broadcast threshold is broadcast, a larger
    one is shuffled. ``how="inner"`` drops unmapped answers right away.
    """
    targets = mapping.withColumn("name", F.lower("name")).withColumnRenamed("name", "_name")
    answers = long.withColumn(name, F.lower(name))
    return answers.join(targets, answers[name] == targets["_name"], how).drop("_name")


def default_if_missing(col: Column, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)


def name_points(mapped: DataFrame, rules: PointRules) -> DataFrame:
    """Mapped answers under their canonical names, with the constant and defaulted columns."""
    require_columns(mapped, [rules.period, rules.unit, "data_element_id", "COC", "value"])
    dropped = ["Calcul", "data_element", "CC", rules.row_id]
    renamed = mapped.drop(*dropped).withColumnsRenamed(
        {
            rules.period: "PERIOD",
            rules.unit: "ORG_UNIT",
            "data_element_id": "DX_UID",
            "value": "VALUE",
            "COC": "CATEGORY_OPTION_COMBO",
        }
    )
    return renamed.withColumns(
        {
            "DATA_TYPE": F.lit("DATA_ELEMENT"),
            "CATEGORY_OPTION_COMBO": default_if_missing(F.col("CATEGORY_OPTION_COMBO"), rules.default_combo),
            "ATTRIBUTE_OPTION_COMBO": F.lit(rules.default_combo),
        }
    )


def known_units(df: DataFrame, prefixes: Sequence[str], column: str = "ORG_UNIT") -> DataFrame:
    """Rows whose unit is given and does not start with a prefix of an unmapped unit."""
    unit = quoted(column)
    kept = df.where(~is_missing(unit))
    return kept.where(~reduce(lambda a, b: a | b, [unit.startswith(p) for p in prefixes])) if prefixes else kept


def blank_to_null(col: Column) -> Column:
    """Null where the text is blank or reads as NaN."""
    text = col.cast("string")
    return F.when(~(is_blank(text) | is_nan_text(text)), col)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null. NaN stays, and Catalyst can turn an outer join below into an inner one,
    neither of which holds for ``dropna``."""
    names = list(columns) if columns is not None else df.columns
    return df.where(reduce(and_, [quoted(c).isNotNull() for c in names])) if names else df


def keep_points(points: DataFrame, rules: PointRules, as_of: date) -> DataFrame:
    """Canonical filters: no future period, a known unit, a usable value, no null anywhere."""
    current = drop_future(points, as_of)
    known = known_units(current, rules.unmapped_prefixes)
    return drop_nulls(known.withColumn("VALUE", blank_to_null(F.col("VALUE"))))


def as_points(df: DataFrame) -> DataFrame:
    """The canonical columns, in order and with their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POINT.fields])
