"""Tables that an operator writes and reads again, in the folder the cluster shares."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldledger.operators.columns import quoted
from fieldledger.session import scratch_dir, settings
from fieldledger.sources.paths import file_system

# Nobody reads the shuffles of a table that has been written; else they stay until the driver collects its garbage.
SHUFFLES_GO = {"spark_sql_classic_shuffleDependency_fileCleanup_enabled": "true"}


def keep(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again, which cuts its lineage.

    ``more`` frames of the same columns go into the same table in turn: the shuffles of one go before the next begins.
    """
    return _kept_at([df, *more], scratch_dir(df.sparkSession, label))


def _kept_at(parts: Sequence[DataFrame], path: str) -> DataFrame:
    for part in parts:
        _add(part, path)
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(path)


def _add(df: DataFrame, path: str) -> None:
    with settings(df.sparkSession, **SHUFFLES_GO):
        df.write.mode("append").parquet(path)


@contextmanager
def short_lived(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A ``keep`` whose tables go when the block ends; nothing that is read later may come from them."""
    paths: list[str] = []

    def keep_meanwhile(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
        paths.append(scratch_dir(spark, label))
        return _kept_at([df, *more], paths[-1])

    try:
        yield keep_meanwhile
    finally:
        for path in paths:
            where, fs = file_system(spark, path)
            fs.delete(where, True)


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """All columns of ``docs`` as one struct, ``row``, beside columns of an operator's own, whose names then clash with none."""
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), *[c.alias(name) for name, c in own.items()])


def unpacked(names: Sequence[str], added: dict[str, Column]) -> list[Column]:
    """The columns ``names`` out of ``row``, and ``added`` ones, which take the place of columns of the same name."""
    taken = {name.lower() for name in added}
    rest = [F.col("row").getField(c).alias(c) for c in names if c.lower() not in taken]
    return rest + [c.alias(name) for name, c in added.items()]


def give_back() -> None:
    """Return what a Python worker has freed to the system; Spark keeps workers, and their memory, for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


SIMPLE = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
}


def _fields(text: str, between: str) -> list[pa.Field]:
    """Fields such as ``a long, b array<int>``; commas inside ``<>`` belong to a type."""
    parts, depth = [""], 0
    for sign in text:
        depth += (sign == "<") - (sign == ">")
        if sign == "," and not depth:
            parts.append("")
        else:
            parts[-1] += sign
    pairs = [part.strip().split(between, 1) for part in parts]
    return [pa.field(name.strip(), _arrow_type(kind.strip())) for name, kind in pairs]


def _arrow_type(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(pa.field("element", _arrow_type(kind[6:-1])))
    if kind.startswith("struct<"):
        return pa.struct(_fields(kind[7:-1], ":"))
    return SIMPLE[kind]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a row type. Tasks use it, where Spark's own parser cannot be reached."""
    return pa.schema(_fields(ddl, " "))


def is_training(doc_id: Column, parts: int, held_out: int) -> tuple[Column, Column]:
    """Whether a row may be learned from, and whether it is held out, by the CRC of its id; null ids are neither."""
    part = F.crc32(doc_id.cast("string").cast("binary")) % parts
    return F.coalesce(part != held_out, F.lit(False)), F.coalesce(part == held_out, F.lit(False))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A 64-bit key of a row from its id and text; rows that repeat share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))
