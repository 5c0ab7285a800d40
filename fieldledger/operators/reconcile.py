"""Counts per unit and period: stage audit, publish mismatches and stage gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.operators.columns import check_choice

# Stages of a run and their audit columns.
STAGES = {"extracted": "extracted_count", "transformed": "transformed_count", "pushed": "pushed_count"}


def unit_counts(points: DataFrame, unit: str = "ORG_UNIT", period: str = "PERIOD") -> DataFrame:
    """Rows per unit and period."""
    return points.groupBy(unit, period).agg(F.count(F.lit(1)).alias("record_count"))


def audit_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Audit table of the given stage datasets (``PERIOD``, ``ORG_UNIT``); one shuffle for all stages."""
    parts = [
        df.select(
            F.col("PERIOD").alias("period"),
            F.col("ORG_UNIT").alias("organization_unit"),
            F.lit(check_choice(stage, list(STAGES), "stage")).alias("stage"),
        )
        for stage, df in stages.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("period", "organization_unit").agg(
        *[F.count_if(F.col("stage") == stage).alias(name) for stage, name in STAGES.items()]
    )


def mismatched_units(points: DataFrame, audit: DataFrame) -> DataFrame:
    """Units whose row count differs from the pushed count; a missing or null count is 0."""
    counts = unit_counts(points)
    pushed = audit.select(
        F.col("organization_unit").alias("_unit"), F.col("period").alias("_period"), "pushed_count"
    )
    joined = counts.join(
        pushed, (counts["ORG_UNIT"] == pushed["_unit"]) & (counts["PERIOD"] == pushed["_period"]), "left"
    )
    found = joined.withColumn("pushed_count", F.coalesce("pushed_count", F.lit(0)))
    return found.where(F.col("record_count") != F.col("pushed_count")).select(
        "ORG_UNIT", "PERIOD", "record_count", "pushed_count"
    )


def stage_gate(periods: DataFrame, audit: DataFrame, stage: str) -> DataFrame:
    """For each requested period, the rows that passed ``stage`` and whether to process it (none did)."""
    check_choice(stage, list(STAGES), "stage")
    done = audit.groupBy(F.col("period").alias("_period")).agg(F.sum(STAGES[stage]).alias("n_done"))
    wanted = periods.select("PERIOD")
    joined = wanted.join(done, wanted["PERIOD"] == done["_period"], "left")
    n_done = F.coalesce("n_done", F.lit(0))
    return joined.select("PERIOD", n_done.alias("n_done"), (n_done == 0).alias("process"))
