"""Profile of values that are not numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.functions.numbers import is_numeric


def non_numeric(points: DataFrame, value: str = "VALUE") -> DataFrame:
    """Rows whose value is not a number; null is not a number."""
    return points.where(~is_numeric(F.col(value)))


def non_numeric_profile(points: DataFrame, by: str = "DX_UID", value: str = "VALUE") -> DataFrame:
    """Rows that are not numbers per target, with the least of their values as a sample."""
    return non_numeric(points, value).groupBy(by).agg(
        F.count(F.lit(1)).alias("count"), F.min(value).alias("sample_alpha_value")
    )
