"""Points packed by submission: the form in which they are shuffled where all points of a unit go the same way."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.operators.canonical import as_points
from fieldledger.operators.keys import PREFIX, key_columns, keys_match
from fieldledger.operators.reshape import lookup, parts, positions, read_number, usable, value_text
from fieldledger.schemas import POINT
from fieldledger.session import kept

UNIT = ["PERIOD", "ORG_UNIT"]
# The columns of a point that its target gives.
TARGET = ["DX_UID", "CATEGORY_OPTION_COMBO", "ATTRIBUTE_OPTION_COMBO", "DATA_TYPE"]
# Name of a hash of the unit.
CODE = PREFIX + "code"


def unit_code() -> Column:
    """64 bits of hash of the unit, never null."""
    return F.xxhash64(*UNIT)


@dataclass(frozen=True)
class Packs:
    """Submissions with one value per target, or none: position ``i`` belongs to ``targets[i]``, which holds the ``TARGET`` columns.

    ``packed`` makes out of ``source``, which has ``PERIOD`` and ``ORG_UNIT``, what tells the values. With ``numbers``
    these are ``_numbers`` with the first ``numbers`` positions and ``_texts`` with the others, as a form holds them: some
    are not usable, and they get their format only where they come out. Without, they are ``at``, the positions that are
    given, each once, and ``value``, their texts. A unit may have any number of rows, and a target may stand at several positions.
    """

    source: DataFrame
    packed: Callable[[DataFrame], DataFrame]
    targets: Sequence[tuple[str | None, ...]]
    numbers: int | None = None

    @property
    def rows(self) -> DataFrame:
        """The unit with ``_numbers`` and ``_texts``, which are looked at by position alone."""
        rows = self.packed(self.source)
        if self.numbers is not None:
            return rows.select(*UNIT, "_numbers", "_texts")
        texts = [F.get("value", F.array_position("at", F.lit(i)).cast("int") - 1) for i in range(len(self.targets))]
        return rows.select(
            *UNIT, F.array().cast("array<double>").alias("_numbers"), F.array(*texts).cast("array<string>").alias("_texts")
        )

    def parts(self, at: Column, before: str = "") -> tuple[Column, Column]:
        """Number and text at a position of ``rows``, whose arrays may have a prefix."""
        return parts(at, self.numbers or 0, before)

    def usable(self, number: Column, text: Column) -> Column:
        """Whether such parts give a value; false or null if not."""
        return text.isNotNull() if self.numbers is None else usable(number, text)

    def read(self, number: Column, text: Column) -> Column:
        """The number of a usable value, null where it is a text."""
        return number if self.numbers is None else read_number(number, text)

    def points(self) -> DataFrame:
        """One row per point."""
        each = opened(self, self.rows, UNIT)
        return as_points(each.select(*UNIT, value_text().alias("VALUE"), *self.given()))

    def given(self) -> list[Column]:
        """The ``TARGET`` columns of position ``_at``."""
        return [lookup([t[k] for t in self.targets], "_at").alias(name) for k, name in enumerate(TARGET)]

    def only(self, units: DataFrame, how: str) -> Packs:
        """The rows whose unit has its code among ``units`` (``left_semi``), or has not (``left_anti``); null is a unit too."""
        return replace(self, source=self.source.join(units, unit_code() == units[CODE], how))


def opened(packs: Packs, rows: DataFrame, others: Sequence[str]) -> DataFrame:
    """One row per usable value: ``others`` of each row, ``_at``, and ``_number`` and ``_text`` as ``value_text`` takes them.

    Positions are exploded, so that tests and formats are compiled once and not once per target.
    """
    number, text = packs.parts(F.col("_at"))
    each = rows.select("*", F.explode(positions(packs.targets)).alias("_at"))
    flat = each.select(*others, "_at", number.alias("_number"), text.alias("_text"))
    given = flat.where(packs.usable(F.col("_number"), F.col("_text")))
    return given.withColumn("_number", packs.read(F.col("_number"), F.col("_text")))


def repeated_units(packs: Packs) -> DataFrame | None:
    """Codes of the units with more than one row, each once; None if there are none.

    Counted from the unit columns alone, on the map side too. Another unit with the same code may come along, so what is
    done with these units has to be right for any unit.
    """
    counted = packs.source.groupBy(unit_code().alias(CODE)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    units = kept(counted.select(CODE), "units")
    return None if units.isEmpty() else units


def matched(current: Packs, posted: Packs, join_hint: str | None = None) -> DataFrame:
    """Current points, each once, with ``_kind`` as ``delta`` tells it; a posted unit has one row at most.

    Units are matched as a whole, and a point is looked for in the row of its unit. The code of the unit goes first, as
    sorts compare its bits and seldom the unit itself.
    """
    old = posted.rows
    old = old.select(
        unit_code().alias(CODE),
        *key_columns(old, UNIT),
        F.col("_numbers").alias("_old_numbers"),
        F.col("_texts").alias("_old_texts"),
    )
    if join_hint is not None:
        old = old.hint(join_hint)
    now = current.rows.select("*", unit_code().alias("_code"))
    joined = now.join(old, (now["_code"] == old[CODE]) & keys_match(now, old, UNIT), "left")
    each = _compared(opened(current, joined, [*UNIT, "_old_numbers", "_old_texts"]), current, posted)
    compared = each.select(*UNIT, value_text().alias("VALUE"), *current.given(), "_kind")
    return compared.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POINT.fields], "_kind")


def _compared(each: DataFrame, current: Packs, posted: Packs) -> DataFrame:
    """Opened current points beside the arrays of their posted unit, with ``_kind``.

    It comes out of an explode of one element: a test on it is not pushed down into a second comparison, and what is made
    of the points that pass is made of no other.
    """
    places: dict[tuple[str | None, ...], list[int]] = {}
    for i, target in enumerate(posted.targets):
        places.setdefault(target[:3], []).append(i)
    wanted = [places.get(target[:3], []) for target in current.targets]
    if max(map(len, wanted), default=0) <= 1:
        place = F.get(F.array(*[F.lit(at[0] if at else None).cast("int") for at in wanted]), F.col("_at"))
        number, text = posted.parts(F.col("_place"), "_old")
        each = each.withColumn("_place", place)
        each = each.withColumns({"_old_number": number, "_old_text": text})
        found = posted.usable(F.col("_old_number"), F.col("_old_text"))
        each = each.withColumns({"_old_number": posted.read(F.col("_old_number"), F.col("_old_text")), "_found": found})
        found, differs = F.col("_found"), _differs(F.col("_old_number"), F.col("_old_text"))
    else:
        several = F.get(F.array(*[F.array(*map(F.lit, at)).cast("array<int>") for at in wanted]), F.col("_at"))

        def other(at: Column) -> Column:
            number, text = posted.parts(at, "_old")
            return posted.usable(number, text) & _differs(posted.read(number, text), text)

        found = F.exists(several, lambda at: posted.usable(*posted.parts(at, "_old")))
        differs = F.exists(several, other)
    # Nothing is found where the unit was not posted.
    kind = F.when(~F.coalesce(found, F.lit(False)), "new").when(differs, "changed")
    return each.select("*", F.explode(F.array(kind)).alias("_kind"))


def _differs(old_number: Column, old_text: Column) -> Column:
    """Whether an old value reads otherwise than ``_number`` and ``_text``, without a format.

    Two numbers have the same text where they are equal, apart from the two zeros. Among the others a number and a text
    read alike for infinities only, which a plain cast writes as the format does.
    """
    number = F.col("_number")
    plain = F.coalesce(number.cast("string"), F.col("_text"))
    old_plain = F.coalesce(old_number.cast("string"), old_text)
    return F.when((number != 0) & old_number.isNotNull(), number != old_number).otherwise(plain != old_plain)
