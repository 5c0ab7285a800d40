"""Align: actions that bring a target hierarchy in line with a source one, and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldledger.operators.hierarchy import alignment_actions, alignment_report, alignment_totals


def write_alignment(
    source: DataFrame,
    target: DataFrame,
    out_path: str,
    version: str | None = None,
    require_parent: bool = True,
) -> DataFrame:
    """Write the actions (payload beside each) and return them as read back."""
    alignment_actions(source, target, version, require_parent).write.mode("overwrite").parquet(out_path)
    return source.sparkSession.read.parquet(out_path)


def settle_alignment(actions: DataFrame, responses: DataFrame, out_path: str) -> DataFrame:
    """Write the report of the actions and their responses; returns totals per action and status."""
    alignment_report(actions, responses).write.mode("overwrite").parquet(out_path)
    return alignment_totals(actions.sparkSession.read.parquet(out_path))
