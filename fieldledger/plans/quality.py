"""Quality report: targets with values that are not numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from fieldledger.operators.quality import non_numeric_profile
from fieldledger.sinks.stages import write_csv
from fieldledger.sources.tabular import read_stage


def report_non_numeric(
    spark: SparkSession,
    transformed_path: str,
    out_path: str,
    only: int | None = None,
    periods: Sequence[int] | None = None,
) -> bool:
    """Profile of a transformed stage as CSV; False if there is no stage."""
    points = read_stage(spark, transformed_path, "parquet", only, periods)
    if points is None:
        return False
    write_csv(non_numeric_profile(points), out_path)
    return True
