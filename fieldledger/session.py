"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fieldledger.sources.paths import file_system


def build_session(app_name: str = "fieldledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, dynamic partition overwrite and UTC times."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # A shuffled join hashes its smaller side instead of sorting both where every partition of
        # that side turns out to be small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_base(spark: SparkSession) -> str:
    """The folder the cluster shares: ``spark.checkpoint.dir``, or one in the warehouse where that is unset.

    A warehouse on the driver's own disk is no shared folder, so outside local mode that raises.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and file_system(spark, base)[1].getScheme() == "file":
        raise ValueError(f"Set spark.checkpoint.dir to a folder that all nodes share; {base} is local")
    return f"{base}/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster shares; what is written there goes when the application ends."""
    base = _shared_base(spark)
    root = f"{base}/run-{spark.sparkContext.applicationId}"
    path, fs = file_system(spark, root)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: computed once, its size known to the planner."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Run with some settings of the session, named with ``_`` for dots, and put back what there was."""
    names = {name.replace("_", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
