"""Completion sync: which units to complete, and the log of those that were."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.functions.periods import distinct_periods, in_periods
from fieldledger.operators.columns import check_choice
from fieldledger.operators.completion import (
    completion_outcomes,
    completion_plan,
    merge_processed,
    newly_processed,
    outcome_tallies,
)
from fieldledger.operators.responses import completion_status, parse_responses
from fieldledger.schemas import IMPORT_COUNTS, IMPORT_STRATEGIES
from fieldledger.session import kept
from fieldledger.sinks.stages import write_stage
from fieldledger.sources.landed import read_processed


def prepare_completion(
    spark: SparkSession,
    requested: DataFrame,
    registrations: DataFrame,
    target_dataset: str,
    log_path: str | None,
    out_path: str,
    import_strategy: str = "CREATE_AND_UPDATE",
    dry_run: bool = True,
    unit_registrations: DataFrame | None = None,
) -> DataFrame:
    """Write the completion plan (payload and import options beside each unit) and read it back."""
    check_choice(import_strategy, IMPORT_STRATEGIES, "import strategy")
    processed = read_processed(spark, log_path) if log_path else requested.where("false")
    plan = completion_plan(
        requested, processed, registrations, target_dataset, unit_registrations=unit_registrations
    )
    options = {
        "importStrategy": F.lit(import_strategy),
        "dryRun": F.lit(dry_run),
        "preheatCache": F.lit(True),
        "skipAudit": F.lit(True),
        "reportMode": F.lit("FULL"),
    }
    plan.withColumns(options).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def settle_completion(
    spark: SparkSession,
    plan: DataFrame,
    responses: DataFrame,
    log_path: str | None,
    out_path: str,
    mark_uncompleted: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Fold responses (``PERIOD``, ``ORG_UNIT``, ``status_code``, ``body``) and extend the log.

    Returns units and push errors per outcome, and the import counts. The log of a period is written
    once, whole.
    """
    statuses = completion_status(parse_responses(responses))
    statuses.select("PERIOD", "ORG_UNIT", "outcome", "push_errors", *IMPORT_COUNTS).write.mode(
        "overwrite"
    ).parquet(f"{out_path}/statuses")
    statuses = spark.read.parquet(f"{out_path}/statuses")
    # Only units that were sent can have a response: the others, most of a plan, are not joined.
    is_sent = F.col("outcome").eqNullSafe("ready")
    outcomes = completion_outcomes(plan.where(is_sent), statuses).unionByName(completion_outcomes(plan.where(~is_sent)))
    outcomes.write.mode("overwrite").parquet(f"{out_path}/outcomes")
    outcomes = spark.read.parquet(f"{out_path}/outcomes")
    if log_path:
        new = newly_processed(outcomes, mark_uncompleted)
        existing = in_periods(read_processed(spark, log_path), kept(distinct_periods(new), "periods"))
        write_stage(merge_processed(existing, new), log_path)
    counts = statuses.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in IMPORT_COUNTS])
    return outcome_tallies(outcomes), counts
