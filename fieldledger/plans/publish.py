"""Publish: delta against the snapshot, batches to send, and the snapshot after the responses.

Sending itself is not done here. ``prepare_publish`` writes the batches; the transport of the
deployment sends them and lands one response per batch; ``settle_publish`` reads the responses and
moves the snapshot on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from fieldledger.functions.periods import distinct_periods, in_periods, period_values
from fieldledger.operators.batches import batch_payloads, batch_points
from fieldledger.operators.canonical import drop_nulls
from fieldledger.operators.columns import check_choice
from fieldledger.operators.delta import delta, delta_with_deletes, next_snapshot
from fieldledger.operators.points import classify_points, point_struct
from fieldledger.operators.responses import (
    check_server_errors,
    fold_counts,
    held_points,
    import_errors,
    parse_responses,
    rejected_points,
)
from fieldledger.schemas import IMPORT_STRATEGIES, PAYLOAD_FIELDS, POINT
from fieldledger.session import kept
from fieldledger.sinks.audit import write_counts
from fieldledger.sinks.snapshots import commit_snapshot
from fieldledger.sinks.stages import write_payloads
from fieldledger.sources.snapshots import read_snapshot
from fieldledger.sources.tabular import read_stage

# Fixed value: points per batch of the main job.
BATCH_SIZE = 1_000
# A written delta: payload rows, how they changed, and what is done with them.
CHANGES = T.StructType(
    [T.StructField(field, POINT[name].dataType) for name, field in PAYLOAD_FIELDS.items()]
    + [T.StructField(name, T.StringType()) for name in ("change_type", "point_class")]
)


@dataclass(frozen=True)
class PublishPaths:
    """Datasets of one publish run, all under one folder."""

    root: str

    @property
    def changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def points(self) -> str:
        return f"{self.root}/points"

    @property
    def payloads(self) -> str:
        return f"{self.root}/payloads"

    @property
    def ignored(self) -> str:
        return f"{self.root}/ignored"

    @property
    def deleted(self) -> str:
        return f"{self.root}/deleted"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def held(self) -> str:
        return f"{self.root}/held"

    @property
    def responses(self) -> str:
        return f"{self.root}/responses"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"


def plan_changes(
    current: DataFrame, posted: DataFrame | None, detect_deletes: bool = False, seen: Observation | None = None
) -> DataFrame:
    """Payload rows of the points to publish, with their ``change_type``; ``seen`` counts as in ``delta``."""
    changes = (delta_with_deletes if detect_deletes else delta)(current, posted, seen=seen)
    fields = [F.col(name).alias(field) for name, field in PAYLOAD_FIELDS.items()]
    return changes.select(*fields, "change_type")


# Points of a delta by what is done with them.
CLASSES = ("valid", "delete", "ignored")


def write_changes(
    current: DataFrame | None, posted: DataFrame | None, paths: PublishPaths, detect_deletes: bool = False
) -> dict[str, int]:
    """Write the delta once, with the class of each point, and count it as it is written.

    Returns the number of points looked at (``all``), of ``changes``, and of those by type and by class.
    """
    names = ("all", "changes", "new", "changed", "removed", *CLASSES)
    if current is None:
        return dict.fromkeys(names, 0)
    seen, written = Observation("delta"), Observation("changes")
    changes = classify_points(plan_changes(current, posted, detect_deletes, seen))
    counts = [F.count(F.lit(1)).alias("changes"), F.count_if(F.col("change_type") == "removed").alias("removed")]
    counts += [F.count_if(F.col("point_class") == kind).alias(kind) for kind in CLASSES]
    changes.observe(written, *counts).write.mode("overwrite").parquet(paths.changes)
    got = {**seen.get, **written.get}
    return {name: got.get(name, 0) for name in names}


def write_batches(
    changes: DataFrame, paths: PublishPaths, size: int, import_strategy: str, dry_run: bool
) -> None:
    """Write batches, payloads and the reports of ignored and deleted points.

    ``changes`` must be written data: it is read once per output. All outputs are replaced, by empty ones if there is
    nothing to send, so that no batch of an earlier run is sent again. A ``point_class`` that was written with them is
    taken as it is, so that the reports read only the files that hold theirs.
    """
    spark = changes.sparkSession
    batch_points(changes, size).write.mode("overwrite").parquet(paths.points)
    batched = spark.read.parquet(paths.points)
    write_payloads(batch_payloads(batched, import_strategy, dry_run), paths.payloads)
    classes = changes if "point_class" in changes.columns else classify_points(changes)
    for kind, path in (("ignored", paths.ignored), ("delete", paths.deleted)):
        classes.where(F.col("point_class") == kind).write.mode("overwrite").parquet(path)


def read_changes(spark: SparkSession, paths: PublishPaths) -> DataFrame:
    """The written delta as payload rows."""
    return spark.read.schema(CHANGES).parquet(paths.changes)


def prepare_publish(
    spark: SparkSession,
    transformed_path: str,
    pushed_path: str,
    paths: PublishPaths,
    file_format: str = "parquet",
    only: int | None = None,
    periods: Sequence[int] | None = None,
    size: int = BATCH_SIZE,
    import_strategy: str = "CREATE_AND_UPDATE",
    dry_run: bool = True,
    detect_deletes: bool = False,
) -> dict[str, int]:
    """Write the delta and its batches; returns the totals of ``write_changes``.

    Without a transformed stage, or without changes, all outputs are empty.
    """
    check_choice(import_strategy, IMPORT_STRATEGIES, "import strategy")
    current = read_stage(spark, transformed_path, file_format, only, periods, POINT)
    posted = read_snapshot(spark, pushed_path, POINT, only, periods, file_format)
    if current is None:
        spark.createDataFrame([], CHANGES).write.mode("overwrite").parquet(paths.changes)
    # The delta is written once: batches, payloads and reports then read it instead of joining again.
    totals = write_changes(current, posted, paths, detect_deletes)
    write_batches(read_changes(spark, paths).drop("change_type"), paths, size, import_strategy, dry_run)
    return totals


def canonical_keys(payload: DataFrame) -> DataFrame:
    """Payload rows under their canonical names."""
    back = {field: name for name, field in PAYLOAD_FIELDS.items()}
    return payload.withColumnsRenamed({f: n for f, n in back.items() if f in payload.columns})


def write_held(paths: PublishPaths, responses: DataFrame) -> dict[str, int]:
    """Write the parsed responses, their errors, the rejected points, and all points that nobody accepted (``held``).

    A server error raises. Returns the folded import counts with the numbers of rejected and held points, which are counted
    as they are written.
    """
    spark = responses.sparkSession
    # Written once, as the other steps read them.
    parse_responses(responses).write.mode("overwrite").parquet(paths.responses)
    parsed = spark.read.parquet(paths.responses)
    check_server_errors(parsed)
    batched = spark.read.parquet(paths.points)
    import_errors(parsed).write.mode("overwrite").parquet(paths.errors)
    summary = fold_counts(parsed).first().asDict()
    summary["held"] = _write_counted(held_points(batched, parsed), paths.held)
    # Rejected points are held, too, and these are fewer than all.
    summary["rejected"] = _write_counted(rejected_points(spark.read.parquet(paths.held), parsed), paths.rejected)
    return summary


def _write_counted(points: DataFrame, path: str) -> int:
    """Write points; their number is counted as they are written."""
    seen = Observation()
    points.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get.get("n", 0)


def settle_publish(
    spark: SparkSession,
    transformed_path: str,
    pushed_path: str,
    paths: PublishPaths,
    responses: DataFrame,
    dry_run: bool,
    file_format: str = "parquet",
    only: int | None = None,
    periods: Sequence[int] | None = None,
    audit_path: str | None = None,
) -> dict[str, int]:
    """Fold the responses, report errors and rejected points, and move the snapshot on.

    A server error raises before the snapshot moves. A dry run never moves it. A point is accepted only if its batch has
    an answer that is no error and does not reject its position; every other point keeps what was posted before and is
    sent again. Only periods with changes are rewritten, in one commit of the versioned snapshot, and a period that has
    no points left is dropped by it; a run that dies leaves the snapshot as it was.

    Returns the import counts, with the numbers of rejected and held points. With ``audit_path``, the points of each unit
    that are posted afterwards are stored as pushed.
    """
    summary = write_held(paths, responses)
    if dry_run:
        return summary
    held = canonical_keys(spark.read.parquet(paths.held))
    table = kept(distinct_periods(read_changes(spark, paths), "period"), "touched")
    touched = period_values(table)
    if not touched:
        return summary
    current = read_stage(spark, transformed_path, file_format, only, periods, POINT)
    current = in_periods(current, table) if current is not None else spark.createDataFrame([], POINT)
    posted = read_snapshot(spark, pushed_path, POINT, periods=touched, file_format=file_format)
    commit_snapshot(next_snapshot(drop_nulls(current), posted, held), pushed_path, touched, file_format=file_format)
    if audit_path is not None:
        now = read_snapshot(spark, pushed_path, POINT, periods=touched, file_format=file_format)
        write_counts(now if now is not None else spark.createDataFrame([], POINT), audit_path, "pushed", touched)
    return summary


def point_report(points: DataFrame) -> DataFrame:
    """Ignored and deleted points of payload rows, with their class and JSON form."""
    classified = classify_points(points).where(F.col("point_class") != "valid")
    return classified.withColumn("point", F.to_json(point_struct()))
