"""Transform: wide submissions to canonical points."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.functions.periods import drop_future, period_values
from fieldledger.operators.canonical import as_points, default_if_missing, known_units
from fieldledger.operators.columns import require_columns
from fieldledger.operators.derive import derive
from fieldledger.operators.packs import UNIT, Packs
from fieldledger.operators.reshape import (
    LITERAL_TARGETS,
    mapped_columns,
    read_targets,
    targets_of,
    unpivot_joined,
    unpivot_mapped,
    unpivot_packed,
)
from fieldledger.schemas import POINT
from fieldledger.session import kept
from fieldledger.settings import Derivations, PointRules
from fieldledger.sinks.audit import write_counts
from fieldledger.sinks.stages import write_stage
from fieldledger.sources.tabular import read_stage


def canonical_points(
    submissions: DataFrame,
    mapping: DataFrame,
    form: Derivations,
    rules: PointRules,
    as_of: date,
    lenient: bool = False,
    literal_targets: int = LITERAL_TARGETS,
) -> DataFrame:
    """Canonical points of wide submissions: derive, map, unpivot, filter. No shuffle.

    Only mapped columns are unpivoted, so the scan reads those and the ids alone, and rows that a
    later filter on period or unit would drop are dropped before they are multiplied. Up to ``literal_targets`` targets
    of the form's columns are put into the projection; more of them are joined by name after the unpivot.
    """
    return _canonical(submissions, mapping, form, rules, as_of, lenient, literal_targets)[0]


def _canonical(
    submissions: DataFrame, mapping: DataFrame, form: Derivations, rules: PointRules, as_of: date, lenient: bool, literal_targets: int
) -> tuple[DataFrame, bool]:
    """``canonical_points``, and whether targets were joined, which may shuffle the rows."""
    wide, names, wanted, targets = _mapped(submissions, mapping, form, rules, as_of, lenient, literal_targets)
    ids = [rules.period, rules.unit]
    if targets is None:
        table = kept(wanted, "targets").withColumn("combo", default_if_missing(F.col("combo"), rules.default_combo))
        return _points(unpivot_joined(wide, ids, mapped_columns(table, names), table), rules), True
    if not targets:
        none = wide.where("false").select(
            F.col(rules.period).alias("PERIOD"),
            F.col(rules.unit).alias("ORG_UNIT"),
            *[F.lit(None).alias(c) for c in ("DX_UID", "CATEGORY_OPTION_COMBO", "ATTRIBUTE_OPTION_COMBO")],
            *[F.lit(None).alias(c) for c in ("VALUE", "DATA_TYPE")],
        )
        return as_points(none), False
    return _points(unpivot_mapped(wide, ids, _with_combo(targets, rules)), rules), False


def packed_points(
    submissions: DataFrame,
    mapping: DataFrame,
    form: Derivations,
    rules: PointRules,
    as_of: date,
    lenient: bool = False,
    literal_targets: int = LITERAL_TARGETS,
) -> Packs | DataFrame:
    """The points of ``canonical_points`` as one row per submission; plain points where targets have to be joined."""
    wide, _, _, targets = _mapped(submissions, mapping, form, rules, as_of, lenient, literal_targets)
    if not targets:
        return canonical_points(submissions, mapping, form, rules, as_of, lenient, literal_targets)
    named = wide.withColumnsRenamed({rules.period: "PERIOD", rules.unit: "ORG_UNIT"})
    named = named.withColumns({"PERIOD": F.col("PERIOD").cast("int"), "ORG_UNIT": F.col("ORG_UNIT").cast("string")})
    source, numbers, places = unpivot_packed(named, UNIT, _with_combo(targets, rules))
    given = [(uid, combo, rules.default_combo, "DATA_ELEMENT") for uid, combo in places]
    return Packs(source, lambda rows: rows, given, numbers)


def _mapped(
    submissions: DataFrame, mapping: DataFrame, form: Derivations, rules: PointRules, as_of: date, lenient: bool, most: int
) -> tuple[DataFrame, list[str], DataFrame, list[tuple[str, str, str | None]] | None]:
    """Derived submissions with their value columns, the targets of these, and those as a list unless more than ``most``."""
    require_columns(submissions, rules.ids)
    rows = known_units(
        drop_future(submissions, as_of, rules.period), rules.unmapped_prefixes, rules.unit
    )
    wide = derive(rows, form, lenient)
    names = [name for name in wide.columns if name not in set(rules.ids)]
    wanted = targets_of(mapping, names)
    return wide, names, wanted, read_targets(wanted, names, most)


def _with_combo(targets: Sequence[tuple[str, str, str | None]], rules: PointRules) -> list[tuple[str, str, str]]:
    return [(name, uid, combo or rules.default_combo) for name, uid, combo in targets]


def _points(long: DataFrame, rules: PointRules) -> DataFrame:
    """Mapped values in the canonical columns.

    Units and values are given by now and the rest is constant, so no further null test is needed.
    """
    return as_points(
        long.select(
            F.col(rules.period).alias("PERIOD"),
            F.col(rules.unit).alias("ORG_UNIT"),
            "DX_UID",
            F.col("COC").alias("CATEGORY_OPTION_COMBO"),
            F.lit(rules.default_combo).alias("ATTRIBUTE_OPTION_COMBO"),
            "VALUE",
            F.lit("DATA_ELEMENT").alias("DATA_TYPE"),
        )
    )


def transform(
    spark: SparkSession,
    raw_path: str,
    transformed_path: str,
    mapping: DataFrame,
    form: Derivations,
    rules: PointRules,
    as_of: date,
    file_format: str = "parquet",
    only: int | None = None,
    periods: Sequence[int] | None = None,
    lenient: bool = False,
    audit_path: str | None = None,
) -> bool:
    """Raw stage to transformed stage for the wanted periods; False if there is no raw stage.

    With ``audit_path``, the rows of each unit are stored as extracted, and its points as transformed.
    """
    raw = read_stage(spark, raw_path, file_format, only, periods)
    if raw is None:
        return False
    if rules.period != "PERIOD":
        # The partition column holds the same period: use it, so that period tests prune partitions.
        raw = raw.drop(rules.period).withColumnRenamed("PERIOD", rules.period)
    points, joined = _canonical(raw, mapping, form, rules, as_of, lenient, LITERAL_TARGETS)
    # The raw stage holds a period per file, and points stay with their submission: they need no shuffle.
    write_stage(points, transformed_path, file_format, gathered=not joined)
    if audit_path is not None:
        rows = raw.select(F.col(rules.period).alias("PERIOD"), F.col(rules.unit).alias("ORG_UNIT"))
        touched = period_values(rows)
        write_counts(rows, audit_path, "extracted", touched)
        done = read_stage(spark, transformed_path, file_format, periods=touched, schema=POINT)
        if done is not None:
            write_counts(done, audit_path, "transformed", touched)
    return True
