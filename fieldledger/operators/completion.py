"""Completion of datasets per unit and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.operators.keys import key_columns, keys_match

LOG_KEYS = ["PERIOD", "ORG_UNIT"]


def unprocessed_units(requested: DataFrame, processed: DataFrame) -> DataFrame:
    """Requested (``PERIOD``, ``ORG_UNIT``) rows that the log lacks; null log entries are ignored."""
    done = processed.where(F.col("ORG_UNIT").isNotNull()).select(*key_columns(processed, LOG_KEYS))
    return requested.join(done, keys_match(requested, done, LOG_KEYS), "left_anti")


def first_registrations(registrations: DataFrame, order: str = "seq") -> DataFrame:
    """The first registration of each unit and period by ``order``.

    An aggregate with map-side reduction, so that a unit with very many rows is no hot spot.
    """
    first = F.min(F.struct(order, "completed", "date", "dataSet")).alias("_first")
    grouped = registrations.where(F.col("organisationUnit").isNotNull()).groupBy("period", "organisationUnit")
    return grouped.agg(first).select(
        "period", "organisationUnit", "_first.completed", "_first.date", "_first.dataSet"
    )


def completion_plan(
    requested: DataFrame,
    processed: DataFrame,
    registrations: DataFrame,
    target_dataset: str,
    order: str = "seq",
    unit_registrations: DataFrame | None = None,
) -> DataFrame:
    """One row per unprocessed unit with its ``outcome`` and, if ready, its payload.

    ``no_completion``: no registration; ``missing_keys``: one without date or state; ``ready``: to
    send. ``unit_registrations`` are those fetched for single units; they count only where
    ``registrations`` has none for the unit.
    """
    ranked = registrations.withColumn("_rank", F.lit(0))
    if unit_registrations is not None:
        ranked = ranked.unionByName(unit_registrations.withColumn("_rank", F.lit(1)))
    ranked = ranked.withColumn("_rank", F.struct("_rank", order))
    found = first_registrations(ranked, "_rank").select(
        F.col("period").cast("int").alias("_period"),
        F.col("organisationUnit").alias("_unit"),
        "completed",
        "date",
    )
    units = unprocessed_units(requested, processed)
    joined = units.join(
        found, (units["PERIOD"] == found["_period"]) & (units["ORG_UNIT"] == found["_unit"]), "left"
    )
    outcome = (
        F.when(F.col("_unit").isNull(), "no_completion")
        .when(F.col("date").isNull() | F.col("completed").isNull(), "missing_keys")
        .otherwise("ready")
    )
    registration = F.struct(
        F.col("ORG_UNIT").alias("organisationUnit"),
        F.col("PERIOD").cast("string").alias("period"),
        "completed",
        "date",
        F.lit(target_dataset).alias("dataSet"),
    )
    payload = F.to_json(F.struct(F.array(registration).alias("completeDataSetRegistrations")))
    planned = joined.withColumn("outcome", outcome)
    return planned.select(
        "PERIOD",
        "ORG_UNIT",
        "completed",
        "date",
        "outcome",
        F.when(F.col("outcome") == "ready", payload).alias("payload"),
    )


def completion_outcomes(plan: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """Final outcome per unit: that of the plan, or for a sent unit that of its response.

    ``statuses`` has ``PERIOD``, ``ORG_UNIT``, ``outcome`` and ``push_errors``; a unit that was sent but
    has no response counts as ``parse_failed``, with one push error.
    """
    base = plan.select("PERIOD", "ORG_UNIT", F.col("outcome").alias("_planned"))
    if statuses is None:
        errors = F.when(F.col("_planned") == "missing_keys", 1).otherwise(0)
        return base.select("PERIOD", "ORG_UNIT", F.col("_planned").alias("outcome"), errors.alias("push_errors"))
    known = statuses.select(
        F.col("PERIOD").alias("_period"),
        F.col("ORG_UNIT").alias("_unit"),
        F.col("outcome").alias("_outcome"),
        F.col("push_errors").alias("_errors"),
    )
    match = (base["PERIOD"] == known["_period"]) & (base["ORG_UNIT"] == known["_unit"])
    joined = base.join(known, match & (base["_planned"] == "ready"), "left")
    sent = F.col("_planned") == "ready"
    outcome = F.when(~sent, F.col("_planned")).otherwise(F.coalesce("_outcome", F.lit("parse_failed")))
    errors = (
        F.when(F.col("_planned") == "missing_keys", 1)
        .when(sent, F.coalesce("_errors", F.lit(1)))
        .otherwise(0)
    )
    return joined.select("PERIOD", "ORG_UNIT", outcome.alias("outcome"), errors.alias("push_errors"))


def outcome_tallies(outcomes: DataFrame) -> DataFrame:
    """Units and push errors per outcome."""
    return outcomes.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("push_errors").alias("push_errors")
    )


def newly_processed(outcomes: DataFrame, mark_uncompleted: bool = False) -> DataFrame:
    """Units to add to the log: pushed ones, and on request those without a completion."""
    kept = ["pushed", "no_completion"] if mark_uncompleted else ["pushed"]
    return outcomes.where(F.col("outcome").isin(kept)).select("PERIOD", "ORG_UNIT")


def merge_processed(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Union of the log and the new units, each once."""
    new = new.select("PERIOD", "ORG_UNIT")
    return (existing.select("PERIOD", "ORG_UNIT").unionByName(new) if existing is not None else new).distinct()
