"""Versioned snapshots: a manifest names the folder of each period, and the last manifest is what readers see."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from fieldledger.sources.paths import file_system, list_periods

MANIFESTS = "_manifests"
DATA = "data"


@dataclass(frozen=True)
class Manifest:
    """A version of a snapshot: the folder of each period, below the snapshot's path, and its format.

    ``version`` 0 stands for a plain stage that no commit has touched yet.
    """

    version: int
    parts: dict[int, tuple[str, str]]

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "parts": {str(p): list(v) for p, v in sorted(self.parts.items())}})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        read = json.loads(text)
        return cls(read["version"], {int(p): (folder, kind) for p, (folder, kind) in read["parts"].items()})


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests there are, rising."""
    folder, fs = file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    found = [re.fullmatch(r"(\d+)\.json", s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(m.group(1)) for m in found if m)


def manifest_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:08d}.json"


def read_manifest(spark: SparkSession, path: str, version: int) -> Manifest:
    target, fs = file_system(spark, manifest_path(path, version))
    stream = fs.open(target)
    try:
        return Manifest.from_json(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def latest_manifest(spark: SparkSession, path: str, file_format: str = "parquet") -> Manifest:
    """The last manifest, or that of a plain stage (partitions ``PERIOD=...`` of one format), which may be empty."""
    numbers = versions(spark, path)
    if numbers:
        return read_manifest(spark, path, numbers[-1])
    return Manifest(0, {p: (f"PERIOD={p}", file_format) for p in list_periods(spark, path)})


def read_snapshot(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    only: int | None = None,
    periods: Sequence[int] | None = None,
    file_format: str = "parquet",
    version: int | None = None,
) -> DataFrame | None:
    """A version of a snapshot (the last one), one of its periods, some of them, or all; None where it has none of them.

    Only the folders of those periods are listed. Folders that a commit wrote hold the period in their files;
    those of a plain stage have it in their names.
    """
    chosen = latest_manifest(spark, path, file_format) if version is None else read_manifest(spark, path, version)
    wanted = {only} if only else set(periods) if periods is not None else set(chosen.parts)
    base = path.rstrip("/")
    groups: dict[tuple[bool, str], list[str]] = {}
    for period, (folder, kind) in sorted(chosen.parts.items()):
        if period in wanted:
            groups.setdefault((folder.startswith(f"{DATA}/"), kind), []).append(f"{base}/{folder}")
    frames = []
    for (written, kind), folders in sorted(groups.items()):
        reader = spark.read.schema(schema)
        if not written:
            reader = reader.option("basePath", base)
        if kind == "csv":
            reader = reader.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        frames.append(getattr(reader, kind)(folders).select(schema.names) if kind == "csv" else reader.parquet(*folders).select(schema.names))
    if not frames:
        return None
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
