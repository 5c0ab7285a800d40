"""Stage datasets and landed CSV files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldledger.functions.numbers import BOOLEAN_PATTERN, DECIMAL_PATTERN, INTEGER_PATTERN, SPECIAL_PATTERN
from fieldledger.functions.periods import select_periods
from fieldledger.operators.columns import check_choice, quoted
from fieldledger.operators.reshape import union_wide
from fieldledger.sources.paths import file_system, first_lines, has_data, list_periods
from fieldledger.sources.snapshots import read_snapshot, versions

# Formats of stage files.
FORMATS = ["csv", "parquet"]
# Fixed value: the period at the end of a flat stage file's name.
PERIOD_IN_NAME = r"_([0-9]{6})\.[^/]*(/[^/]*)?$"


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("quote", '"').option("escape", '"').option("multiLine", multi_line)


def header_names(raw: Sequence[str | None]) -> list[str]:
    """Header cells as names; an exact repeat gets the suffix ``_duplicated_0``, ``_1``, …"""
    seen: dict[str, int] = {}
    names = []
    for cell in raw:
        name = cell or ""
        names.append(f"{name}_duplicated_{seen[name] - 1}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    return names


def infer_types(texts: DataFrame) -> list[T.DataType]:
    """Types that every cell fits; one aggregate over all rows, so that no later cell can be lost.

    Tried in the order whole number, number, boolean; a column without a value is text.
    """
    tests = []
    for name in texts.columns:
        cell = F.col(name)
        whole = cell.rlike(INTEGER_PATTERN) & cell.try_cast("bigint").isNotNull()
        tests += [
            F.count(cell).alias(f"{name}_all"),
            F.count_if(whole).alias(f"{name}_whole"),
            F.count_if(cell.rlike(DECIMAL_PATTERN) | cell.rlike(SPECIAL_PATTERN)).alias(f"{name}_number"),
            F.count_if(cell.rlike(BOOLEAN_PATTERN)).alias(f"{name}_boolean"),
        ]
    row = texts.agg(*tests).first()
    kinds: list[T.DataType] = []
    for name in texts.columns:
        n = row[f"{name}_all"]
        if n and row[f"{name}_whole"] == n:
            kinds.append(T.LongType())
        elif n and row[f"{name}_number"] == n:
            kinds.append(T.DoubleType())
        elif n and row[f"{name}_boolean"] == n:
            kinds.append(T.BooleanType())
        else:
            kinds.append(T.StringType())
    return kinds


def lenient_cell(cell: Column, kind: T.DataType) -> Column:
    """A CSV cell as ``kind``; a cell that does not fit is null."""
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.BooleanType):
        return F.when(cell.rlike(BOOLEAN_PATTERN), cell.try_cast(kind))
    if isinstance(kind, T.DoubleType):
        return F.when(cell.rlike(DECIMAL_PATTERN) | cell.rlike(SPECIAL_PATTERN), cell.try_cast(kind))
    return F.when(cell.rlike(INTEGER_PATTERN), cell.try_cast(kind))


def _cells(spark: SparkSession, names: Sequence[str], files: Sequence[str], multi_line: bool, base: str | None = None) -> DataFrame:
    """CSV files of one header with every cell as text, and ``PERIOD`` from the folders below ``base`` if given."""
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
    reader = _csv(spark, multi_line).option("header", True)
    if base is None:
        return reader.schema(T.StructType(fields)).csv(list(files)).toDF(*names)
    schema = T.StructType([*fields, T.StructField("PERIOD", T.IntegerType())])
    return reader.schema(schema).option("basePath", base).csv(list(files)).toDF(*names, "PERIOD")


def _header(spark: SparkSession, files: str | Sequence[str], multi_line: bool) -> list[str]:
    first = _csv(spark, multi_line).option("header", False).csv(files).first()
    return header_names(list(first)) if first is not None else []


def header_groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Files by their first line, of which the beginnings alone are read and no job is run; empty ones are left out.

    A first line that ends inside quotes does not tell the whole header; such a file is a group of its own.
    """
    # The paths come with percent codes.
    files = [unquote(file) for file in spark.read.text(list(paths)).inputFiles()]
    groups: dict[tuple[str, str | None], list[str]] = {}
    for file, line in first_lines(spark, files).items():
        groups.setdefault((line, file if line.count('"') % 2 else None), []).append(file)
    return sorted(sorted(same) for same in groups.values())


def _typed(texts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``texts`` with columns ``names`` as the types that all their cells fit, and the other columns as they are."""
    slots = [f"c{i}" for i in range(len(names))]
    others = [c for c in texts.columns if c not in set(names)]
    slotted = texts.select(*[quoted(n).alias(s) for n, s in zip(names, slots, strict=True)], *others)
    kinds = infer_types(slotted.select(*slots))
    cells = [lenient_cell(F.col(s), k).alias(s) for s, k in zip(slots, kinds, strict=True)]
    return slotted.select(*cells, *others).toDF(*names, *others)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """A landed CSV file, or a folder of parts with the same header.

    Types come from all rows, in one more pass, so that every cell fits its column. With a ``schema`` there is no such
    pass. Answers may hold line breaks, so quoted cells span lines unless ``multi_line`` is off; then large files
    are split.
    """
    if schema is not None:
        return _csv(spark, multi_line).schema(schema).option("header", True).csv(path)
    names = _header(spark, path, multi_line)
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    return _typed(_cells(spark, names, [path], multi_line), names)


def read_csv_fetches(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame | None:
    """Several fetched CSV files (one per period) as one frame with every cell as text.

    A cell keeps its text whatever the other cells of its column are. Files with the same header are one read, and a
    column that a header lacks is null there. None if no file has a data row. With a ``schema`` no header is looked at.
    """
    if schema is not None:
        frame = _csv(spark, multi_line).schema(schema).option("header", True).csv(list(paths))
        return None if frame.isEmpty() else frame
    groups = header_groups(spark, paths)
    if not groups:
        return None
    frames = [_cells(spark, _header(spark, files[0], multi_line), files, multi_line) for files in groups]
    union = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    return None if union.isEmpty() else union


def read_stage(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    only: int | None = None,
    periods: Sequence[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """A stage dataset partitioned by ``PERIOD``, pruned to the wanted periods; None if it is absent.

    Periods written by different runs may differ in columns and types: all columns come back, null where a period
    has none, and types are widened (``common_type``). With a ``schema`` no footer or header is looked at.
    A versioned snapshot is read by its last manifest and needs a schema.
    """
    check_choice(file_format, FORMATS, "file format")
    if versions(spark, path):
        if schema is None:
            raise ValueError(f"{path} is a versioned snapshot; give its schema")
        return read_snapshot(spark, path, schema, only, list(periods) if periods else None)
    if not has_data(spark, path):
        return None
    if file_format == "csv":
        df = _read_csv_stage(spark, path, schema)
    elif schema is not None:
        df = spark.read.schema(schema).parquet(path)
    else:
        df = _read_parquet_stage(spark, path)
    return select_periods(df, only, list(periods) if periods else None)


def _read_parquet_stage(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all periods; one job reads the footers."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    # Types differ: a period is written by one job, so its own schema is known from any of its files.
    folders = [f"{path.rstrip('/')}/PERIOD={period}" for period in list_periods(spark, path)]
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda folder: spark.read.parquet(folder).schema.json(), folders))
    groups: dict[str, list[str]] = {}
    for schema, folder in zip(schemas, folders, strict=True):
        groups.setdefault(schema, []).append(folder)
    reader = spark.read.option("basePath", path)
    return union_wide([reader.parquet(*same) for same in groups.values()])


def _read_csv_stage(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    if schema is not None:
        return _csv(spark, True).option("header", True).schema(schema).csv(path)
    groups = header_groups(spark, [path])
    if len(groups) == 1:
        groups = [[path]]
    frames = []
    for files in groups:
        names = [n for n in _csv(spark, True).option("header", True).csv(files[0]).columns if n != "PERIOD"]
        frames.append(_cells(spark, names, files, True, base=path))
    texts = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    typed = _typed(texts, [n for n in texts.columns if n != "PERIOD"])
    return typed.select(*[quoted(n) for n in typed.columns if n != "PERIOD"], "PERIOD")


def period_in_name(path: Column) -> Column:
    """Period at the end of a file's name, null if there is none."""
    return F.regexp_extract(path, PERIOD_IN_NAME, 1).try_cast("int")


def list_flat_files(spark: SparkSession, path: str, file_format: str) -> dict[str, int]:
    """Stage files ``<name>_<YYYYMM>.<format>`` below ``path`` and their periods; names alone tell, no file is opened."""
    found: dict[str, int] = {}
    folder, fs = file_system(spark, path)
    waiting = [folder]
    while waiting:
        for status in fs.listStatus(waiting.pop()):
            entry = status.getPath()
            match = re.search(rf"_([0-9]{{6}})\.{file_format}$", entry.getName())
            if match:
                found[entry.toString()] = int(match.group(1))
            elif status.isDirectory() and not entry.getName().startswith(("_", ".")):
                waiting.append(entry)
    return found


def read_flat_stage(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    only: int | None = None,
    periods: Sequence[int] | None = None,
) -> DataFrame | None:
    """Flat stage files named ``<name>_<YYYYMM>.<format>``, with ``PERIOD`` taken from the name; None if there are none.

    Such a file may be a folder of parts. Files of other formats, and of periods that are not asked for, are not opened.
    """
    check_choice(file_format, FORMATS, "file format")
    wanted = {only} if only else set(periods) if periods else None
    files = list_flat_files(spark, path, file_format)
    chosen = sorted(file for file, period in files.items() if wanted is None or period in wanted)
    if not chosen:
        return None
    if file_format == "csv":
        df = _csv(spark, True).option("header", True).option("recursiveFileLookup", True).csv(chosen)
    else:
        df = spark.read.option("recursiveFileLookup", True).parquet(*chosen)
    return df.select("*", period_in_name(F.col("_metadata.file_path")).alias("PERIOD"))
