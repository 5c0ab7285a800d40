"""Monthly periods as ``YYYYMM`` integers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Date format of run parameters, and a valid monthly period.
ISO_DATE = "yyyy-M-d"
MONTH_PATTERN = r"^[0-9]{4}(0[1-9]|1[0-2])$"


def period_of(col: Column) -> Column:
    """``YYYYMM`` of a date or timestamp."""
    return F.year(col) * 100 + F.month(col)


def period_start(col: Column) -> Column:
    """First day of a ``YYYYMM`` period."""
    return F.make_date(F.floor(col / 100).cast("int"), (col % 100).cast("int"), F.lit(1))


def iso_date(col: Column) -> Column:
    """Date of an ISO text, null where the text is not one."""
    return F.try_to_date(col, ISO_DATE)


def check_iso_date(text: str | None) -> str | None:
    """A run parameter as ``YYYY-MM-DD``; empty gives None, anything else raises."""
    return datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d") if text else None


def is_month(col: Column) -> Column:
    """True where the value is a well-formed monthly period; false for null."""
    return F.coalesce(col.cast("string").rlike(MONTH_PATTERN), F.lit(False))


def months_between(first: Column, last: Column) -> Column:
    """Array of the periods from one date to another, both included."""
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    return F.transform(months, period_of)


def previous_months(as_of: Column, count: int) -> Column:
    """Array of the ``count`` periods before the one of ``as_of``, latest first."""
    back = F.sequence(F.lit(1), F.lit(count))
    return F.transform(back, lambda n: period_of(F.add_months(F.trunc(as_of, "MM"), -n)))


def period_spine(spark: SparkSession, start: str, end: str | None = None) -> DataFrame:
    """One row per period from ``start`` to ``end`` (today if not given)."""
    first = datetime.strptime(start, "%Y-%m-%d").date()
    last = datetime.strptime(end, "%Y-%m-%d").date() if end else date.today()
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    return spark.range(1).select(F.explode(months_between(F.lit(first), F.lit(last))).alias("PERIOD"))


def previous_periods(spark: SparkSession, count: int, as_of: date | None = None) -> DataFrame:
    """One row per period of the ``count`` months before ``as_of`` (today if not given)."""
    if count < 1:
        return spark.createDataFrame([], "PERIOD int")
    as_of = as_of or date.today()
    return spark.range(1).select(F.explode(previous_months(F.lit(as_of), count)).alias("PERIOD"))


def run_periods(
    spark: SparkSession,
    start: str | None = None,
    end: str | None = None,
    scheduled: bool = False,
    lookback: int = 3,
    as_of: date | None = None,
) -> list[int] | None:
    """Periods of a run: a given start wins over the scheduled lookback; None means all.

    The list has one entry per month, so it is small by nature and becomes a pruning filter.
    """
    if start:
        if end is None and as_of is not None:
            end = as_of.isoformat()
        spine = period_spine(spark, start, end)
    elif scheduled:
        spine = previous_periods(spark, lookback, as_of)
    else:
        return None
    return [row.PERIOD for row in spine.collect()]


def select_periods(
    df: DataFrame, only: int | None = None, periods: list[int] | None = None, column: str = "PERIOD"
) -> DataFrame:
    """Rows of one period if given, else of a list of periods if given, else all.

    Plain equality on the partition column, so whole partitions are pruned.
    """
    if only:
        return df.where(F.col(column) == only)
    if periods:
        return df.where(F.col(column).isin(list(periods)))
    return df


def distinct_periods(df: DataFrame, column: str = "PERIOD") -> DataFrame:
    """The periods of ``df``, each once."""
    return df.select(F.col(column).alias("PERIOD")).where(F.col("PERIOD").isNotNull()).distinct()


def period_values(df: DataFrame, column: str = "PERIOD") -> list[int]:
    """The periods of ``df`` as a list: the names of the partitions a write replaces, one number per month."""
    return sorted(row.PERIOD for row in distinct_periods(df, column).collect())


def in_periods(df: DataFrame, periods: DataFrame, column: str = "PERIOD") -> DataFrame:
    """Rows whose period is in a period table: a semi join on the period.

    Where ``df`` is partitioned by it, only the partitions of the periods found at run time are read (dynamic partition
    pruning), however many there are. Spark does so for a table with a filter; the comparison holds for every period.
    """
    wanted = periods.select(F.col(periods.columns[0]).alias("_period")).where(F.col("_period") > -1)
    return df.join(wanted, df[column] == wanted["_period"], "left_semi")


def drop_future(df: DataFrame, as_of: date, column: str = "PERIOD") -> DataFrame:
    """Rows whose period is not after the one of ``as_of``; a null period is dropped too."""
    return df.where(F.col(column) <= as_of.year * 100 + as_of.month)
