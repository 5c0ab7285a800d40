"""Points against the published snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog import inputs
from fieldledger.catalog.registry import query, table
from fieldledger.functions.periods import months_between
from fieldledger.operators import delta as cdc, reconcile
from fieldledger.streaming.incoming import late_changes as late_delta

_ON = " AND ".join(f"c.{k} = p.{k}" for k in inputs.KEYS_SQL.split(", "))


def _delta_sql(current: str, posted: str) -> str:
    return f"""
      SELECT c.*, 'new' AS change_type FROM ({current}) c ANTI JOIN ({posted}) p ON {_ON}
      UNION ALL SELECT c.*, 'changed' FROM ({current}) c JOIN (
        SELECT {inputs.KEYS_SQL}, min(VALUE) AS lo, max(VALUE) AS hi FROM ({posted}) GROUP BY ALL) p ON {_ON}
      WHERE c.VALUE <> lo OR c.VALUE <> hi"""


@query(_delta_sql(inputs.ORDER_POINTS_SQL, inputs.ORDER_EARLIER_SQL))
def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and changed points where keys are unique."""
    return cdc.delta(inputs.order_points(spark, sf_dir), inputs.order_earlier(spark, sf_dir))


@query(_delta_sql(inputs.ORDER_POINTS_SQL, inputs.ORDER_EARLIER_SQL))
def delta_unique_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the snapshot is known to have unique keys: its rows need no counting."""
    current, posted = inputs.order_points(spark, sf_dir), inputs.order_earlier(spark, sf_dir)
    return cdc.delta(current, posted, posted_unique=True)


@query(_delta_sql(inputs.POINTS_SQL, inputs.EARLIER_POINTS_SQL))
def delta_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions to canonical points to delta, with keys that repeat on both sides."""
    return cdc.delta(inputs.packs(spark, sf_dir), inputs.earlier_packs(spark, sf_dir), join_hint="merge")


_BY_UNIT = [
    "concat('S', l_suppkey) AS ORG_UNIT",
    f"{inputs.SHIP_PERIOD} AS PERIOD",
    "l_returnflag AS DX_UID",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS CATEGORY_OPTION_COMBO",
    "'aoc' AS ATTRIBUTE_OPTION_COMBO",
    "nullif(CAST(CAST(l_tax * 100 AS INT) AS VARCHAR(10)), '0') AS VALUE",
]
_BY_UNIT_SQL = f"SELECT {', '.join(_BY_UNIT)} FROM lineitem"
_BY_UNIT_EARLIER_SQL = f"{_BY_UNIT_SQL} WHERE l_discount < 0.08"


@query(_delta_sql(_BY_UNIT_SQL, _BY_UNIT_EARLIER_SQL))
def delta_heavy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per key, null key fields and null values on both sides."""
    lines = table(spark, sf_dir, "lineitem")
    return cdc.delta(lines.selectExpr(*_BY_UNIT), lines.where("l_discount < 0.08").selectExpr(*_BY_UNIT))


@query(
    f"""SELECT 'all' AS metric, count(*) AS n FROM ({inputs.POINTS_SQL}) UNION ALL
    SELECT change_type, count(*) FROM ({_delta_sql(inputs.POINTS_SQL, inputs.EARLIER_POINTS_SQL)}) GROUP BY 1"""
)
def delta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a delta run."""
    return cdc.delta_counts(inputs.packs(spark, sf_dir), inputs.earlier_packs(spark, sf_dir), join_hint="merge")


@query(
    f"""{_delta_sql(inputs.ORDER_EARLIER_SQL, inputs.ORDER_POINTS_SQL)} UNION ALL
    SELECT p.* REPLACE (NULL AS VALUE), 'removed' FROM ({inputs.ORDER_POINTS_SQL}) p
    ANTI JOIN ({inputs.ORDER_EARLIER_SQL}) c ON {_ON}"""
)
def delta_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta with removed points, from the later state back to the earlier one."""
    current, posted = inputs.order_earlier(spark, sf_dir), inputs.order_points(spark, sf_dir)
    return cdc.delta_with_deletes(current, posted)


@query(
    f"""SELECT {inputs.KEYS_SQL}, count(*) AS n_rows, min(VALUE) AS min_value, max(VALUE) AS max_value
    FROM ({inputs.POINTS_SQL}) GROUP BY ALL HAVING count(*) > 1"""
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once."""
    return cdc.duplicate_keys(inputs.packs(spark, sf_dir))


_REJECTED = "PERIOD % 100 IN (1, 2) AND CATEGORY_OPTION_COMBO = 'cocLow'"


@query(
    f"""WITH c AS ({inputs.ORDER_POINTS_SQL}), p AS ({inputs.ORDER_EARLIER_SQL}),
      r AS (SELECT DISTINCT {inputs.KEYS_SQL} FROM c WHERE {_REJECTED})
    SELECT c.* FROM c ANTI JOIN r p ON {_ON} UNION ALL
    SELECT p.* FROM p SEMI JOIN r c ON {_ON}"""
)
def next_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot after a publish in which some points were rejected."""
    current, posted = inputs.order_points(spark, sf_dir), inputs.order_earlier(spark, sf_dir)
    return cdc.next_snapshot(current, posted, current.where(_REJECTED))


def _recent_sql(source: str) -> str:
    return f"SELECT * FROM ({source}) WHERE PERIOD IN (200004, 200005, 200006)"


@query(_delta_sql(_recent_sql(inputs.ORDER_POINTS_SQL), _recent_sql(inputs.ORDER_EARLIER_SQL)))
def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheduled run repeats the three periods before its own and publishes what moved."""
    current, posted = inputs.order_points(spark, sf_dir), inputs.order_earlier(spark, sf_dir)
    return late_delta(current, posted, date(2000, 7, 15))


@query(f"SELECT ORG_UNIT, PERIOD, count(*) AS record_count FROM ({inputs.ORDER_POINTS_SQL}) GROUP BY ALL")
def unit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per unit and period."""
    return reconcile.unit_counts(inputs.order_points(spark, sf_dir))


_STAGES_SQL = f"""SELECT PERIOD, ORG_UNIT, 'extracted' AS stage FROM ({inputs.ORDER_POINTS_SQL})
  UNION ALL SELECT PERIOD, ORG_UNIT, 'transformed' FROM ({inputs.ORDER_POINTS_SQL}) WHERE DX_UID <> ORG_UNIT
  UNION ALL SELECT PERIOD, ORG_UNIT, 'pushed' FROM ({inputs.ORDER_EARLIER_SQL}) WHERE PERIOD < 200001"""
_AUDIT_SQL = f"""SELECT PERIOD AS period, ORG_UNIT AS organization_unit,
    CAST(count_if(stage = 'extracted') AS BIGINT) AS extracted_count,
    CAST(count_if(stage = 'transformed') AS BIGINT) AS transformed_count,
    CAST(count_if(stage = 'pushed') AS BIGINT) AS pushed_count
  FROM ({_STAGES_SQL}) GROUP BY ALL"""


@query(_AUDIT_SQL)
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per unit, period and stage, from the stage datasets."""
    current = inputs.order_points(spark, sf_dir)
    return reconcile.audit_counts(
        {
            "extracted": current,
            "transformed": current,
            "pushed": inputs.order_earlier(spark, sf_dir).where("PERIOD < 200001"),
        }
    )


@query(
    f"""SELECT ORG_UNIT, c.PERIOD, record_count, coalesce(pushed_count, 0) AS pushed_count
    FROM (SELECT ORG_UNIT, PERIOD, count(*) AS record_count FROM ({inputs.ORDER_POINTS_SQL}) GROUP BY ALL) c
    LEFT JOIN ({_AUDIT_SQL}) a ON a.organization_unit = c.ORG_UNIT AND a.period = c.PERIOD
    WHERE record_count <> coalesce(pushed_count, 0)"""
)
def publish_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units whose row count is not the pushed count."""
    return reconcile.mismatched_units(inputs.order_points(spark, sf_dir), audit_counts(spark, sf_dir))


@query(
    f"""WITH spine AS (SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS PERIOD FROM (SELECT unnest(generate_series(
        date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders))
    SELECT PERIOD, CAST(coalesce(n, 0) AS BIGINT) AS n_done, coalesce(n, 0) = 0 AS process FROM spine
    LEFT JOIN (SELECT period AS p, sum(pushed_count) AS n FROM ({_AUDIT_SQL}) GROUP BY 1) ON p = PERIOD"""
)
def stage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods still to push, out of all periods of the orders."""
    span = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    periods = span.select(F.explode(months_between(F.col("a"), F.col("b"))).alias("PERIOD"))
    return reconcile.stage_gate(periods, audit_counts(spark, sf_dir), "pushed")
