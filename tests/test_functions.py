"""Text, number and period functions on edge values."""

import sys
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from fieldledger.functions import numbers, periods, text


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, values, kind, build):
    return [r[0] for r in column(spark, values, kind).select(build(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("Déjà vu (x)", "deja_vu_x"),
        ("  Poids [kg]  ", "poids_kg"),
        ("casorientcs-5_f", "casorientcs-5_f"),
        ("a.b\tc", "ab\tc"),
        ("ÉCOLE  Ñ", "ecole__n"),
        ("", ""),
    ],
)
def test_clean_names(spark, raw, cleaned):
    assert text.clean_names([raw, "Z", raw]) == [cleaned, "z", cleaned]


def test_names_are_cleaned_as_texts_are(spark):
    odd = ["İstanbul", "ΟΔΟΣ ΣΑΣ", "ǅ", "ẞ", "\x1c x \x1f", "Ａ１", "한글", "ﬁ", "a\u0301\u00a0b"]
    assert text.clean_names(odd) == apply(spark, odd, "string", text.clean_text)
    assert text.clean_names([]) == []


def test_cleaning_drops_every_combining_mark(spark):
    marks = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))]
    assert len(marks) > 500
    assert set(apply(spark, ["a" + m + "b" for m in marks], "string", text.clean_text)) == {"ab"}


def test_clean_text_column(spark):
    values = ["Déjà vu (x)", None, "한글 É", "x" * 5000 + "é", "\x1c a\u00a0b \u2003", "½ Ⅷ ٣"]
    expected = ["deja_vu_x", None, unicodedata.normalize("NFD", "한글_e"), "x" * 5000 + "e", "a\u00a0b", "½_ⅷ_٣"]
    assert apply(spark, values, "string", text.clean_text) == expected


def test_blank(spark):
    values = [None, "", " ", "\t\n", "  ", " a ", "a"]
    assert apply(spark, values, "string", text.is_blank) == [None, True, True, True, True, False, False]
    assert apply(spark, values, "string", text.is_missing) == [True] * 5 + [False, False]
    assert apply(spark, [" a\t"], "string", text.strip) == ["a"]


def test_is_numeric(spark):
    cases = {
        "5": True, "-3.5": True, ".5": True, "5.": True, "1e5": True, "NaN": True, "inf": True,
        "1d": False, " 5 ": False, "1_000": False, "": False, "abc": False, None: False,
    }
    assert apply(spark, list(cases), "string", numbers.is_numeric) == list(cases.values())


def test_value_to_string(spark):
    cases = {
        5.0: "5.0", 2.5: "2.5", 12345678.0: "12345678.0", 12345678.25: "12345678.25", 0.00001: "0.00001",
        -12345678.5: "-12345678.5", 0.0: "0.0", 1e15: "1.0E15", float("inf"): "Infinity", None: None,
        1.23456789012e-9: "1.23456789012E-9",
    }
    got = apply(spark, list(cases), "double", lambda c: numbers.value_to_string(c, T.DoubleType()))
    assert got == list(cases.values())
    assert apply(spark, [0.1], "float", lambda c: numbers.value_to_string(c, T.FloatType())) == ["0.1"]
    assert apply(spark, [7], "int", lambda c: numbers.value_to_string(c, T.IntegerType())) == ["7"]
    assert apply(spark, [True], "boolean", lambda c: numbers.value_to_string(c, T.BooleanType())) == ["true"]


def test_different_numbers_never_share_a_text(spark):
    values = [1.5e-10, 1.5000001e-10, 1.23456789e-8, 123456789.125, 123456789.1250001, 0.1 + 0.2, 0.3]
    got = apply(spark, values, "double", lambda c: numbers.value_to_string(c, T.DoubleType()))
    assert [float(v) for v in got] == values


def test_strict_and_lenient_casts(spark):
    lenient = apply(spark, ["3", "x", None], "string", lambda c: numbers.to_double(c, lenient=True))
    assert lenient == [3.0, None, None]
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["x"], "string", numbers.to_double)


def test_nan_text(spark):
    assert apply(spark, ["NaN", "nan", "-nan", "5", None], "string", numbers.is_nan_text) == [
        True, True, True, False, None,
    ]


def test_period_lists(spark):
    assert [r[0] for r in periods.period_spine(spark, "2023-11-30", "2024-02-01").collect()] == [
        202311, 202312, 202401, 202402,
    ]
    assert [r[0] for r in periods.previous_periods(spark, 3, date(2024, 2, 29)).collect()] == [
        202401, 202312, 202311,
    ]
    assert periods.previous_periods(spark, 0).count() == 0
    with pytest.raises(ValueError, match="after"):
        periods.period_spine(spark, "2024-02-01", "2024-01-01")


def test_run_periods_precedence(spark):
    as_of = date(2024, 3, 15)
    assert periods.run_periods(spark, "2024-01-31", None, True, as_of=as_of) == [202401, 202402, 202403]
    assert periods.run_periods(spark, None, "2024-02-01", True, as_of=as_of) == [202402, 202401, 202312]
    assert periods.run_periods(spark, None, "2024-02-01") is None


def test_iso_dates(spark):
    assert periods.check_iso_date("2024-1-5") == "2024-01-05"
    assert periods.check_iso_date("") is None
    with pytest.raises(ValueError):
        periods.check_iso_date("05/01/2024")
    got = apply(spark, ["2024-1-5", "2024-02-30", "05/01/2024", None], "string", periods.iso_date)
    assert got == [date(2024, 1, 5), None, None, None]


def test_period_checks(spark):
    assert apply(spark, ["202401", "202413", "2024", None], "string", periods.is_month) == [
        True, False, False, False,
    ]


def test_select_periods(spark):
    df = spark.createDataFrame([(202401,), (202402,), (None,)], "PERIOD int")
    assert periods.select_periods(df, 202401, [202402]).collect()[0][0] == 202401
    assert periods.select_periods(df, None, [202402]).collect()[0][0] == 202402
    assert periods.select_periods(df).count() == 3
    assert periods.drop_future(df, date(2024, 1, 31)).count() == 1
