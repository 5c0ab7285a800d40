"""Number functions: numeric tests, lenient casts and number formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# What counts as a number in text. Spark's cast also takes "1d" and " 5 ".
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
SPECIAL_PATTERN = r"^[+-]?(?i:nan|inf|infinity)$"
BOOLEAN_PATTERN = r"^(?i:true|false)$"
NAN_TEXTS = ["nan", "+nan", "-nan"]


def is_numeric(col: Column) -> Column:
    """True where the text reads as a number (NaN and infinities included); false for null."""
    text = col.cast("string")
    return F.coalesce(text.rlike(DECIMAL_PATTERN) | text.rlike(SPECIAL_PATTERN), F.lit(False))


def to_double(col: Column, lenient: bool = False) -> Column:
    """Cast to double; bad text raises, or gives null when ``lenient``."""
    return col.try_cast("double") if lenient else col.cast("double")


def is_nan_text(col: Column) -> Column:
    """True where the text reads as NaN; null for null."""
    # The last letter is looked at first, which is cheap.
    return (col.endswith("n") | col.endswith("N")) & F.lower(col).isin(NAN_TEXTS)


def widen_float(col: Column) -> Column:
    """A float as the double that reads the same in text."""
    return col.cast("string").cast("double")


def value_to_string(col: Column, kind: T.DataType) -> Column:
    """Text of a value, without exponents for ordinary magnitudes.

    Published text is compared with later text, so the format must never depend on magnitude:
    ``12345678.0`` and ``0.00001``, not ``1.2345678E7`` and ``1.0E-5``.
    """
    if isinstance(kind, T.FloatType):
        return value_to_string(widen_float(col), T.DoubleType())
    if not isinstance(kind, T.DoubleType):
        return col.cast("string")
    size = F.abs(col)
    plain = (size >= 1e-3) & (size < 1e7) | (col == 0)
    whole = (size < 1e15) & (col == F.floor(col))
    digits = F.regexp_replace(F.format_string("%.15f", col), r"0+$", "")
    return (
        F.when(plain, col.cast("string"))
        .when(whole, F.concat(col.cast("bigint").cast("string"), F.lit(".0")))
        .when((size < 1e15) & (digits.try_cast("double") == col), digits)
        .otherwise(col.cast("string"))
    )
