"""Files taken in as they arrive, each once, and published against the snapshot."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fieldledger.functions.periods import period_values, previous_months
from fieldledger.operators.canonical import drop_nulls
from fieldledger.operators.delta import delta, next_snapshot
from fieldledger.operators.keys import key_rows, keys_match
from fieldledger.plans.publish import (
    PublishPaths,
    canonical_keys,
    read_changes,
    write_batches,
    write_changes,
    write_held,
)
from fieldledger.schemas import POINT, POINT_KEYS
from fieldledger.sinks.snapshots import commit_snapshot
from fieldledger.sources.paths import is_complete, list_folders
from fieldledger.sources.snapshots import read_snapshot


def trailing_periods(points: DataFrame, as_of: date, count: int = 3) -> DataFrame:
    """Points of the ``count`` periods before the one of ``as_of``: those a scheduled run repeats.

    Late submissions for these periods are picked up, and the delta publishes only what moved.
    """
    return points.where(F.array_contains(previous_months(F.lit(as_of), count), F.col("PERIOD")))


def late_changes(current: DataFrame, posted: DataFrame, as_of: date, count: int = 3) -> DataFrame:
    """Delta of the trailing periods."""
    return delta(trailing_periods(current, as_of, count), trailing_periods(posted, as_of, count))


def upsert_snapshot(points: DataFrame, posted: DataFrame | None) -> DataFrame:
    """Arrived points, and the posted rows whose keys did not arrive."""
    if posted is None:
        return points
    keys = key_rows(points, POINT_KEYS)
    return points.unionByName(posted.join(keys, keys_match(posted, keys, POINT_KEYS), "left_anti"))


# Sends the batches of an epoch and gives their responses, one row per batch as ``schemas.RESPONSE``.
Answers = Callable[[int, PublishPaths], DataFrame]


def _epoch_root(out_path: str, epoch: int) -> str:
    return f"{out_path}/epoch={epoch}"


def last_epoch(spark: SparkSession, out_path: str) -> int | None:
    """The last epoch that was published to its end."""
    done = [e for e in list_folders(spark, out_path, "epoch") if is_complete(spark, f"{_epoch_root(out_path, e)}/pending")]
    return max(done, default=None)


def _turns(spark: SparkSession, out_path: str, epoch: int) -> list[str]:
    """Folders of an epoch and of the times its pending points were sent again, those that came to their end."""
    root = _epoch_root(out_path, epoch)
    roots = [root, *[f"{root}/retry={n}" for n in list_folders(spark, root, "retry")]]
    return [r for r in roots if is_complete(spark, f"{r}/pending")]


def read_pending(spark: SparkSession, out_path: str, epoch: int) -> DataFrame | None:
    """Points that nobody has accepted up to an epoch, or None if it has not been published."""
    turns = _turns(spark, out_path, epoch)
    return spark.read.schema(POINT).parquet(f"{turns[-1]}/pending") if turns else None


def _publish_points(
    points: DataFrame, paths: PublishPaths, epoch: int, pushed_path: str, size: int, dry_run: bool, answers: Answers
) -> dict[str, int]:
    """Publish written points: delta, batches, answers, snapshot, and what nobody accepted as ``pending``, last.

    ``pending`` tells that a turn is done. A repeated turn does no harm: its batches come from the delta written first,
    and the snapshot update gives the same snapshot again.
    """
    spark = points.sparkSession
    touched = period_values(points)
    posted = read_snapshot(spark, pushed_path, POINT, periods=touched)
    totals = {} if is_complete(spark, paths.changes) else write_changes(points, posted, paths)
    write_batches(read_changes(spark, paths).drop("change_type"), paths, size, "CREATE_AND_UPDATE", dry_run)
    pending = f"{paths.root}/pending"
    if dry_run:
        points.write.mode("overwrite").parquet(pending)
        return totals
    totals |= write_held(paths, answers(epoch, paths))
    held = canonical_keys(spark.read.parquet(paths.held))
    # Of the posted rows, those of keys that were not accepted stay, whether they arrived or not.
    snapshot = upsert_snapshot(next_snapshot(drop_nulls(points), None, held), posted)
    if touched:
        # A point without a period is never sent, and has no place in a snapshot.
        commit_snapshot(snapshot.where(F.col("PERIOD").isNotNull()), pushed_path, touched)
    keys = key_rows(held, POINT_KEYS)
    points.join(keys, keys_match(points, keys, POINT_KEYS), "left_semi").write.mode("overwrite").parquet(pending)
    return totals


def publish_arrivals(
    arrived: DataFrame, epoch: int, pushed_path: str, out_path: str, size: int, dry_run: bool, answers: Answers
) -> dict[str, int]:
    """Publish one micro-batch of canonical points under ``out_path/epoch=<n>``; returns the totals of the run.

    Only points with a good answer enter the snapshot. The others are points of the next epoch too, unless their keys
    arrive there again, until they are accepted; ``retry_pending`` sends them without waiting for a file.
    """
    spark = arrived.sparkSession
    paths = PublishPaths(_epoch_root(out_path, epoch))
    if not is_complete(spark, f"{paths.root}/arrived"):
        waiting = read_pending(spark, out_path, epoch - 1)
        upsert_snapshot(arrived, waiting).write.mode("overwrite").parquet(f"{paths.root}/arrived")
    points = spark.read.schema(POINT).parquet(f"{paths.root}/arrived")
    return _publish_points(points, paths, epoch, pushed_path, size, dry_run, answers)


def retry_pending(
    spark: SparkSession, pushed_path: str, out_path: str, answers: Answers, size: int = 1_000, dry_run: bool = False
) -> dict[str, int] | None:
    """Send the pending points of the last epoch again, without a new file; None if there are none.

    A scheduled run calls it when the stream has ended. It is a turn of its own under the epoch, ``retry=<n>``; the
    next epoch, or the next retry, goes on from what it leaves. A turn that died is done again from its beginning.
    """
    epoch = last_epoch(spark, out_path)
    waiting = read_pending(spark, out_path, epoch) if epoch is not None else None
    if waiting is None or waiting.isEmpty():
        return None
    turns = _turns(spark, out_path, epoch)
    paths = PublishPaths(f"{_epoch_root(out_path, epoch)}/retry={len(turns)}")
    return _publish_points(waiting, paths, epoch, pushed_path, size, dry_run, answers)


def publish_incoming(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    to_points: Callable[[DataFrame], DataFrame],
    pushed_path: str,
    out_path: str,
    checkpoint_path: str,
    answers: Answers,
    size: int = 1_000,
    dry_run: bool = False,
    files_per_batch: int | None = 1,
) -> StreamingQuery:
    """Publish every Parquet file of ``landing_path`` that no earlier run has taken in, then stop.

    Files are taken in order of arrival, one per micro-batch, so that a later file for the same keys
    wins; more per micro-batch, or with None all that have landed, are fine where files that a
    run finds never share keys. ``answers`` sends the batches of an epoch and gives their responses; a batch
    without an answer is not accepted. See ``publish_arrivals``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.parquet(landing_path)

    def publish(batch: DataFrame, epoch: int) -> None:
        publish_arrivals(to_points(batch), epoch, pushed_path, out_path, size, dry_run, answers)

    return (
        files.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
