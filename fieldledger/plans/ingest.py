"""Ingest: landed submissions to the raw stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldledger.functions.periods import select_periods
from fieldledger.operators.choices import one_hot, replace_labels
from fieldledger.operators.columns import clean_columns, quoted, require_columns, sort_columns
from fieldledger.sinks.stages import write_stage
from fieldledger.sources.tabular import read_csv_fetches


def select_submissions(
    submissions: DataFrame,
    only: int | None = None,
    periods: Sequence[int] | None = None,
    start: int | None = None,
    end: int | None = None,
    updated_since: str | None = None,
    period: str = "periode",
    updated: str = "updated_at",
) -> DataFrame:
    """Submissions a run asks for; every test is a plain comparison that Spark can push down."""
    chosen = select_periods(submissions, only, list(periods) if periods else None, period)
    tests: list[Column] = []
    if start:
        tests.append(F.col(period) >= start)
    if end:
        tests.append(F.col(period) <= end)
    if updated_since is not None:
        tests.append(F.col(updated) >= F.lit(updated_since))
    for test in tests:
        chosen = chosen.where(test)
    return chosen


def clean_submissions(
    submissions: DataFrame, choices: DataFrame | None = None, multiple: Sequence[str] = ()
) -> DataFrame:
    """Labels for codes if ``choices`` is given, clean names, one column per choice, sorted columns."""
    labelled = replace_labels(submissions, choices, multiple) if choices is not None else submissions
    return sort_columns(one_hot(clean_columns(labelled)))


def ingest(
    spark: SparkSession,
    paths: Sequence[str],
    raw_path: str,
    file_format: str = "parquet",
    choices: DataFrame | None = None,
    multiple: Sequence[str] = (),
    period: str = "periode",
    only: int | None = None,
    periods: Sequence[int] | None = None,
    start: int | None = None,
    end: int | None = None,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    updated_since: str | None = None,
    updated: str = "updated_at",
) -> bool:
    """Landed CSV files to the raw stage, a partition per period; False if no file has data.

    Cells stay text. Only the periods asked for are written: one, a list, or those from ``start`` to ``end``; and only
    submissions of which ``updated`` (an ISO date or time) is not before ``updated_since``. Without line breaks inside cells,
    ``multi_line=False`` lets Spark split large files.
    """
    submissions = read_csv_fetches(spark, paths, schema, multi_line)
    if submissions is None:
        return False
    cleaned = require_columns(clean_submissions(submissions, choices, multiple), [period])
    # A period that is no number raises: its rows would be lost.
    dated = cleaned.withColumn(period, quoted(period).cast("double").cast("int"))
    chosen = select_submissions(dated, only, periods, start, end, updated_since, period, updated)
    write_stage(chosen, raw_path, file_format, period)
    return True
