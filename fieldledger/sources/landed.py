"""Landed JSON and Parquet inputs with fixed schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldledger import schemas
from fieldledger.operators.columns import check_choice
from fieldledger.sources.paths import has_data, path_exists


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping of question names to targets: a JSON list of records, or several files with one each."""
    return spark.read.schema(schemas.MAPPING).option("multiLine", True).json(path).select(*schemas.MAPPING.names)


def read_choices(spark: SparkSession, path: str) -> DataFrame:
    """Choice labels of a form: a JSON list of ``question``, ``code``, ``label``."""
    return spark.read.schema(schemas.CHOICES).option("multiLine", True).json(path)


_SLASHES = ":/+"


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """Organisation units: a JSON list of records.

    ``seq`` tells their order: the file's place among the names of the files, then the place inside it. A file is read
    as a whole, in order, so that the row ids of its records rise.
    """
    units = spark.read.schema(schemas.ORG_UNIT).option("multiLine", True).json(path)
    # Spark names a file with one slash after the scheme here and with three there.
    places = [(re.sub(_SLASHES, ":/", file), rank) for rank, file in enumerate(sorted(units.inputFiles()))]
    files = spark.createDataFrame(places, "_path string, _rank long")
    placed = units.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))  # what is above it numbers the task
    ranked = placed.join(files, F.regexp_replace("_file", _SLASHES, ":/") == F.col("_path"))
    order = F.shiftleft(F.col("_rank"), 33).bitwiseOR(within)
    return ranked.select(*[order.alias("seq") if c == "seq" else F.col(c) for c in schemas.ORG_UNIT.names])


def read_audit(spark: SparkSession, path: str, period: int | None = None) -> DataFrame:
    """Audit counts, of one period if given."""
    audit = spark.read.schema(schemas.AUDIT).parquet(path)
    return audit.where(F.col("period") == period) if period else audit


def explode_registrations(documents: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per registration of documents ``{"completeDataSetRegistrations": [...]}``.

    ``seq`` tells their order: the document's, then that inside it.
    """
    rank = order if order is not None else F.lit(0)
    listed = documents.select(
        rank.alias("_rank"), F.posexplode("completeDataSetRegistrations").alias("_pos", "_row")
    )
    return listed.select("_row.*", F.struct("_rank", "_pos").alias("seq"))


# What a document of registrations is made of, cut after each closing brace.
_LIST = r'"completeDataSetRegistrations"\s*:\s*'
_ELEMENT = rf"^\s*(?:\{{\s*{_LIST}\[|,)\s*\{{([^{{}}]*)$"
_EMPTY = rf"^\s*\{{\s*(?:{_LIST}(?:\[\s*\]\s*|null\s*))?$"
_END = r"^[\s\]]*$"


def _file_of(df: DataFrame) -> Column:
    """Path of the file of a row as it can be read again: Spark gives it with percent codes, and a plus sign as it is."""
    return F.url_decode(F.replace(df["_metadata.file_path"], F.lit("+"), F.lit("%2B")))


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Landed documents cut after each ``}``: large files are read by many tasks, and no row holds a whole document.

    ``_row`` is the registration of a piece, ``_odd`` tells that a piece is neither one nor what stands around them.
    ``seq`` is the file, the place of the block in it, and the place in the block, as the row ids of a block's pieces rise.
    """
    text = spark.read.option("lineSep", "}").text(paths)
    place = F.struct(
        _file_of(text).alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    body = F.concat(F.lit("{"), F.regexp_extract("value", _ELEMENT, 1), F.lit("}"))
    is_element = F.col("value").rlike(_ELEMENT) & F.coalesce(F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT"), F.lit(False))
    around = F.col("value").rlike(_EMPTY) | F.col("value").rlike(_END)
    row = F.when(is_element, F.from_json(body, schemas.REGISTRATION))
    return text.select(place.alias("seq"), row.alias("_row"), (~is_element & ~around).alias("_odd"))


def read_registrations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Registrations of one landed document per parent unit, in order of file name and of the place inside it.

    Registrations are flat records, so a document is read in pieces that end with a record, however large it is. A file
    for which that does not hold (a brace inside a text, a list that is not the first field) is read as a whole instead.
    """
    pieces = _pieces(spark, paths)
    odd = [r[0] for r in pieces.where("_odd").select("seq._file").distinct().collect()]
    flat = pieces.where(F.col("_row").isNotNull() & ~F.col("seq._file").isin(odd)).select("_row.*", "seq")
    if not odd:
        return flat
    whole = spark.read.schema(schemas.REGISTRATIONS).option("multiLine", True).json(odd)
    documents = whole.select("completeDataSetRegistrations", _file_of(whole).alias("_file"))
    listed = documents.select("_file", F.posexplode("completeDataSetRegistrations").alias("_pos", "_row"))
    place = F.struct("_file", F.lit(0).cast("long").alias("_block"), F.col("_pos").cast("long").alias("_pos"))
    return flat.unionByName(listed.select("_row.*", place.alias("seq")))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Log of processed units; an absent log, or one without ``ORG_UNIT``, is empty."""
    empty = spark.createDataFrame([], schemas.PROCESSED)
    if not has_data(spark, path):
        return empty
    log = spark.read.parquet(path)
    if not {"ORG_UNIT", "PERIOD"} <= set(log.columns):
        return empty
    return log.select(F.col("PERIOD").cast("int").alias("PERIOD"), "ORG_UNIT")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Import responses, one JSON line per batch: ``batch_id``, ``status_code``, ``body`` as text."""
    return spark.read.schema(schemas.RESPONSE).json(path)


def _wanted(df: DataFrame, column: str, wanted: Sequence[str] | DataFrame | None) -> DataFrame:
    if wanted is None:
        return df
    if isinstance(wanted, DataFrame):
        ids = wanted.select(F.col(wanted.columns[0]).alias("_id"))
        return df.join(ids, df[column] == ids["_id"], "left_semi")
    return df.where(F.col(column).isin(list(wanted)))


def read_values(
    spark: SparkSession,
    path: str,
    data_type: str,
    products: Sequence[str] | DataFrame | None = None,
    units: Sequence[str] | DataFrame | None = None,
    periods: Sequence[str] | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Landed values of one data type, limited to products, units and periods.

    Short lists become pushed-down filters, tables become semi joins. A reporting rate is asked for by
    its full ``<id>.<rate>`` text.
    """
    check_choice(data_type, schemas.DATA_TYPES, "data type")
    check_choice(file_format, ["json", "parquet"], "file format")
    schema = schemas.DATA_ELEMENT_VALUES if data_type == "DATA_ELEMENT" else schemas.ANALYTICS_VALUES
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return limit_values(getattr(reader, file_format)(path), data_type, products, units, periods)


def limit_values(
    values: DataFrame,
    data_type: str,
    products: Sequence[str] | DataFrame | None = None,
    units: Sequence[str] | DataFrame | None = None,
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """Values of some products, units and periods."""
    element = data_type == "DATA_ELEMENT"
    product, unit, period = ("dataElement", "orgUnit", "period") if element else ("dx", "ou", "pe")
    if periods is not None:
        values = values.where(F.col(period).isin([str(p) for p in periods]))
    return _wanted(_wanted(values, product, products), unit, units)
