"""Stage datasets: one partition per period, each replaced as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldledger.operators.columns import check_choice, quoted, sort_rows
from fieldledger.session import settings
from fieldledger.sources.paths import file_system
from fieldledger.sources.tabular import FORMATS

# How gathered rows are read and written: small splits, since rows may multiply, and a file per period of a split. Spark
# counts 4 MB for opening a file, so that a split holds at most 4; beyond these periods it sorts what is left.
GATHERED = {"spark_sql_files_maxPartitionBytes": "16m", "spark_sql_maxConcurrentOutputFileWriters": "16"}


def write_stage(
    df: DataFrame, path: str, file_format: str = "parquet", period: str = "PERIOD", ordered: bool = False, gathered: bool = False
) -> None:
    """Replace the partitions of the periods in ``df``; other periods, and an empty ``df``, change nothing.

    Rows without a period are not written. Spark stages the files and moves them when the job
    commits, so a failed job leaves the old partitions. Rows are gathered by period with a rebalance:
    small periods share files, and a period of any size spreads over many tasks. ``ordered`` sorts
    rows by every column instead (range partitions that start with the period).

    ``gathered`` says that rows come straight from files of one period each, such as those of a stage, without a shuffle:
    then none is needed. A task reads a few files and keeps one file open for each of their periods, so that rows need no
    sorting either; there are at most as many files as were read, or splits of them.
    """
    check_choice(file_format, FORMATS, "file format")
    df = df.where(quoted(period).isNotNull())
    if period != "PERIOD":
        df = df.withColumn("PERIOD", quoted(period).cast("int"))
    if ordered:
        shaped = sort_rows(df, within="PERIOD")
    else:
        shaped = df if gathered else df.hint("rebalance", "PERIOD")
    writer = shaped.write.mode("overwrite").partitionBy("PERIOD").option("partitionOverwriteMode", "dynamic")
    with settings(df.sparkSession, **(GATHERED if gathered else {})):
        if file_format == "csv":
            writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        else:
            writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def replace_parquet(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned Parquet dataset: write beside it, then swap by rename.

    A failing write leaves the old dataset and no remains; readers see the old or the new one.
    """
    spark = df.sparkSession
    target, fs = file_system(spark, path)
    tag = uuid.uuid4().hex
    staged, _ = file_system(spark, f"{path.rstrip('/')}._new_{tag}")
    old, _ = file_system(spark, f"{path.rstrip('/')}._old_{tag}")
    try:
        df.write.parquet(staged.toString())
    except Exception:
        fs.delete(staged, True)
        raise
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        fs.delete(staged, True)
        raise OSError(f"cannot replace {path}")
    if not fs.rename(staged, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"cannot write {path}")
    if replaced:
        fs.delete(old, True)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Payloads as JSON lines, one per batch, with the import options beside each."""
    payloads.write.mode("overwrite").json(path)


def write_table(df: DataFrame, table: str, mode: str = "replace") -> None:
    """A table, replaced or appended to; appending needs the same columns and types."""
    check_choice(mode, ["append", "replace"], "save mode")
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(table):
        have = {f.name: f.dataType for f in spark.table(table).schema.fields}
        given = {f.name: f.dataType for f in df.schema.fields}
        if have != given:
            wrong = sorted(set(have.items()) ^ set(given.items()), key=str)
            raise ValueError(f"Schema of {table} differs: {wrong}")
        df.select(*[quoted(name) for name in spark.table(table).columns]).write.mode("append").insertInto(table)
    else:
        df.write.mode("overwrite" if mode == "replace" else "append").saveAsTable(table)
