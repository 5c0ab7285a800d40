"""Stored audit counts: what each stage of a run left per unit and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fieldledger.operators.columns import check_choice
from fieldledger.operators.reconcile import STAGES, unit_counts
from fieldledger.schemas import AUDIT
from fieldledger.sinks.snapshots import commit_snapshot
from fieldledger.sources.snapshots import read_snapshot

COUNTS = T.StructType(
    [T.StructField("PERIOD", T.IntegerType()), T.StructField("ORG_UNIT", T.StringType()), T.StructField("record_count", T.LongType())]
)


def write_counts(rows: DataFrame, audit_path: str, stage: str, touched: Sequence[int]) -> None:
    """Rows per unit of the ``touched`` periods, as what ``stage`` now holds of them; other periods keep their counts.

    A period without rows has no counts afterwards. Each stage has a versioned snapshot of its own, so runs of different
    stages do not meet.
    """
    check_choice(stage, list(STAGES), "stage")
    counts = unit_counts(rows.where(F.col("PERIOD").isNotNull())).select(*COUNTS.names)
    commit_snapshot(counts, f"{audit_path.rstrip('/')}/{stage}", touched)


def read_counts(spark: SparkSession, audit_path: str, period: int | None = None) -> DataFrame:
    """The audit table: the stored counts of all stages merged per unit and period, 0 where a stage has none."""
    parts = []
    for stage, name in STAGES.items():
        stored = read_snapshot(spark, f"{audit_path.rstrip('/')}/{stage}", COUNTS, period)
        if stored is not None:
            zeros = {other: F.lit(0).cast("long") for other in STAGES.values()}
            parts.append(stored.select("PERIOD", "ORG_UNIT", *[(F.col("record_count") if n == name else z).alias(n) for n, z in zeros.items()]))
    if not parts:
        return spark.createDataFrame([], AUDIT)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    keys = (F.col("PERIOD").alias("period"), F.col("ORG_UNIT").alias("organization_unit"))
    return every.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in STAGES.values()])
