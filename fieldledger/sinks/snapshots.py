"""Commits of versioned snapshots: new folders first, then one manifest that swaps all of them in."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fieldledger.sources.paths import file_system, list_periods
from fieldledger.sources.snapshots import DATA, Manifest, latest_manifest, manifest_path, read_manifest, versions


def commit_snapshot(
    df: DataFrame, path: str, touched: Sequence[int], period: str = "PERIOD", file_format: str = "parquet", keep: int = 2
) -> Manifest:
    """Replace the ``touched`` periods of a snapshot by the rows of ``df``, all of them at once.

    Rows are written below ``data/<tag>``, a folder per period. Then one manifest is renamed into place: it names the new
    folders, those of periods that were not touched, and no folder for a touched period without rows. Readers see
    the version before or the one after; a commit that dies in between leaves the version before. Rows of periods that
    are not ``touched``, and rows without a period, are an error and leave the version before, too.

    There is one writer at a time: a commit that finds its version taken raises. The last ``keep`` versions stay readable,
    folders that none of them names are removed. A plain stage found at ``path`` is taken over as it is, not copied.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    before = latest_manifest(spark, path, file_format)
    tag = uuid.uuid4().hex
    named = df.withColumn("of_period", F.col(period))
    named.hint("rebalance", "of_period").write.partitionBy("of_period").parquet(f"{base}/{DATA}/{tag}")
    written = list_periods(spark, f"{base}/{DATA}/{tag}", "of_period")
    if not set(written) <= set(touched) or _without_period(spark, f"{base}/{DATA}/{tag}"):
        raise ValueError(f"Rows of periods that are not to be replaced: {sorted(set(written) - set(touched)) or 'null'}")
    parts = {p: part for p, part in before.parts.items() if p not in set(touched)}
    parts |= {p: (f"{DATA}/{tag}/of_period={p}", "parquet") for p in written}
    after = Manifest(before.version + 1, parts)
    _publish(spark, path, after)
    _clean(spark, path, keep)
    return after


def _without_period(spark, folder: str) -> bool:
    target, fs = file_system(spark, f"{folder}/of_period=__HIVE_DEFAULT_PARTITION__")
    return fs.exists(target)


def _publish(spark, path: str, manifest: Manifest) -> None:
    """Write a manifest beside its place and rename it, so that it is seen whole or not at all."""
    target, fs = file_system(spark, manifest_path(path, manifest.version))
    if fs.exists(target):
        raise OSError(f"Version {manifest.version} of {path} has been written by another job")
    staged, _ = file_system(spark, f"{target.getParent().toString()}/._{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    stream.write(bytearray(manifest.to_json().encode()))
    stream.close()
    if not fs.rename(staged, target):
        raise OSError(f"cannot write {target.toString()}")


def _clean(spark, path: str, keep: int) -> None:
    """Remove manifests before the last ``keep``, and folders of commits that the rest does not name.

    Folders of a plain stage go with the manifests that name them.
    """
    base = path.rstrip("/")
    numbers = versions(spark, path)
    kept = [read_manifest(spark, path, v) for v in numbers[-keep:]]
    used = {folder for manifest in kept for folder, _ in manifest.parts.values()}
    tags = {folder.split("/")[1] for folder in used if folder.startswith(f"{DATA}/")}
    for version in numbers[:-keep]:
        old, fs = file_system(spark, manifest_path(path, version))
        fs.delete(old, False)
    data, fs = file_system(spark, f"{base}/{DATA}")
    for status in fs.listStatus(data):
        name = status.getPath().getName()
        if name not in tags:
            fs.delete(status.getPath(), True)
            continue
        for part in fs.listStatus(status.getPath()):
            if "=" in part.getPath().getName() and f"{DATA}/{name}/{part.getPath().getName()}" not in used:
                fs.delete(part.getPath(), True)
    if kept[0].version >= keep:
        for period in list_periods(spark, path):
            if f"PERIOD={period}" not in used:
                fs.delete(file_system(spark, f"{base}/PERIOD={period}")[0], True)
