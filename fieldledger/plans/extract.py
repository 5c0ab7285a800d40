"""Extract: landed values of three data types to standard points, a partition per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.functions.periods import is_month
from fieldledger.operators.columns import check_choice
from fieldledger.operators.standard import to_standard
from fieldledger.sinks.stages import write_stage
from fieldledger.sources.landed import read_values
from fieldledger.sources.paths import list_periods

# Whether an extract replaces what is there or only adds missing periods.
MODES = ["DOWNLOAD_REPLACE", "DOWNLOAD_NEW"]


def check_periods(spark: SparkSession, periods: Sequence[int | str]) -> list[int]:
    """The periods as numbers; a malformed one raises. One small expression over the list."""
    texts = [str(p) for p in periods]
    if not texts:
        return []
    wrong = F.filter(F.array(*[F.lit(t) for t in texts]), lambda p: ~is_month(p))
    bad = spark.range(1).select(wrong.alias("bad")).first().bad
    if bad:
        raise ValueError(f"Invalid period format: {', '.join(bad)}")
    return [int(t) for t in texts]


def periods_to_extract(spark: SparkSession, out_path: str, periods: Sequence[int], mode: str) -> list[int]:
    """All requested periods, or only those that are not there yet."""
    check_choice(mode, MODES, "download mode")
    if mode == "DOWNLOAD_REPLACE":
        return list(periods)
    existing = set(list_periods(spark, out_path))
    return [p for p in periods if p not in existing]


def write_extract(standard: DataFrame, out_path: str, periods: Sequence[int], mode: str) -> list[int]:
    """Write standard points of the requested periods; returns the periods asked of the source."""
    todo = periods_to_extract(standard.sparkSession, out_path, periods, mode)
    if todo:
        chosen = standard.withColumn("PERIOD", F.col("PERIOD").cast("int")).where(F.col("PERIOD").isin(todo))
        write_stage(chosen, out_path)
    return todo


def extract(
    spark: SparkSession,
    landed_path: str,
    out_path: str,
    data_type: str,
    products: Sequence[str] | DataFrame,
    units: Sequence[str] | DataFrame,
    periods: Sequence[int | str],
    mode: str = "DOWNLOAD_REPLACE",
    domain_type: str = "AGGREGATED",
    return_existing: bool = False,
    file_format: str = "parquet",
) -> dict[int, str | None]:
    """Extract one data type for the given periods; returns the dataset folder of each period.

    A period without data writes nothing and has no folder; one skipped because it exists has its
    folder only if ``return_existing``.
    """
    wanted = check_periods(spark, periods)
    todo = periods_to_extract(spark, out_path, wanted, mode)
    if todo:
        values = read_values(spark, landed_path, data_type, products, units, [str(p) for p in todo], file_format)
        write_extract(to_standard(values, data_type, domain_type), out_path, todo, "DOWNLOAD_REPLACE")
    present = set(list_periods(spark, out_path))
    shown = set(wanted) if return_existing else set(todo)
    return {p: f"{out_path}/PERIOD={p}" if p in present & shown else None for p in wanted}
