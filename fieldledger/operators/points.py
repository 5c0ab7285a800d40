"""Payload rows: projection, classification and JSON form."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldledger.functions.text import is_missing
from fieldledger.operators.columns import quoted, require_columns
from fieldledger.schemas import PAYLOAD_FIELDS, POINT_FIELDS


def payload_rows(points: DataFrame) -> DataFrame:
    """Canonical points under their payload names and in payload order."""
    require_columns(points, list(PAYLOAD_FIELDS))
    return points.select(*[F.col(name).alias(field) for name, field in PAYLOAD_FIELDS.items()])


def with_point_fields(points: DataFrame) -> DataFrame:
    """Check the fields of a point; ``dx`` is taken for ``dataElement``."""
    if "dataElement" not in points.columns and "dx" in points.columns:
        points = points.withColumnRenamed("dx", "dataElement")
    return require_columns(points, POINT_FIELDS)


def _given(points: DataFrame, name: str) -> Column:
    col = quoted(name)
    if isinstance(points.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def classify_points(points: DataFrame) -> DataFrame:
    """Add ``point_class``: ``valid`` has every field, ``delete`` all but the value, ``ignored`` the rest."""
    points = with_point_fields(points)
    keyed = reduce(and_, [_given(points, name) for name in POINT_FIELDS if name != "value"])
    valued = _given(points, "value")
    kind = F.when(~keyed, "ignored").when(valued, "valid").otherwise("delete")
    return points.withColumn("point_class", kind)


def point_struct() -> Column:
    """One published point; a null or blank value becomes an empty one with a comment."""
    gone = is_missing(F.col("value").cast("string"))
    return F.struct(
        *[F.col(name) for name in POINT_FIELDS if name != "value"],
        F.when(gone, F.lit("")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(gone, F.lit("deleted value")).alias("comment"),
    )


def point_json(points: DataFrame) -> DataFrame:
    """Add ``point``, the JSON text of each row; fields that are null are left out."""
    return points.withColumn("point", F.to_json(point_struct()))
