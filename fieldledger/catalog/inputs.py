"""Inputs the queries share: the driver tables seen as submissions, points, units and responses.

Each is a list of expressions that Spark and the checking SQL read alike, so both sides start from
the same rows. Nulls, blanks and odd cases come from values the tables hold.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog.registry import table
from fieldledger.operators.canonical import as_points
from fieldledger.operators.packs import Packs
from fieldledger.plans.transform import canonical_points, packed_points
from fieldledger.settings import DEFAULT_COMBO, Derivations, PointRules

AS_OF = date(2000, 12, 31)
RULES = PointRules(unmapped_prefixes=("raw#", "ssc"))

SHIP_PERIOD = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT)"
ORDER_PERIOD = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)"

_FORM = [
    "l_orderkey * 8 + l_linenumber AS export_id",
    f"{SHIP_PERIOD} AS periode",
    "CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN concat(' ', chr(9)) "
    "WHEN l_quantity = 3 THEN concat('raw#', l_suppkey) WHEN l_quantity = 4 THEN concat('ssc', l_suppkey) "
    "ELSE concat('U', l_orderkey, '-', l_linenumber) END AS reference_externe",
    "l_extendedprice AS price",
    "nullif(l_discount, 0) AS discount",
    "nullif(l_tax, 0) AS tax",
    "CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'R' THEN 'no' ELSE 'Yes' END AS returned",
    "CASE l_linestatus WHEN 'F' THEN '1' ELSE '0' END AS closed",
    "CASE WHEN l_quantity = 50 THEN ' ' WHEN l_quantity = 49 THEN 'NaN' WHEN l_quantity = 48 THEN 'many' "
    "ELSE CAST(l_linenumber AS VARCHAR(10)) END AS remark",
]
SUBMISSIONS = [*_FORM[:3], "l_quantity AS quantity", *_FORM[3:]]
# The earlier state: lines still open were not there, and fully discounted ones had another quantity.
EARLIER = [*_FORM[:3], "CASE WHEN l_discount > 0.05 THEN l_quantity + 1 ELSE l_quantity END AS quantity", *_FORM[3:]]
EARLIER_ROWS = "NOT (l_returnflag = 'N' AND l_linestatus = 'O')"

SUBMISSIONS_SQL = f"SELECT {', '.join(SUBMISSIONS)} FROM lineitem"
EARLIER_SQL = f"SELECT {', '.join(EARLIER)} FROM lineitem WHERE {EARLIER_ROWS}"

FORM = Derivations(
    sums=[["quantity", "discount"], ["price", "discount", "tax"]],
    halves=["price", "quantity"],
    flags=[("returned", "count yes returned"), ("closed", "count yes closed"), ("closed", "count yes closed 2")],
)

# name, target id, combination; one name has two targets, two names match no column.
MAPPING_ROWS = [
    ("Quantity", "dxQuantity", "cocA"),
    ("quantity", "dxQuantityCopy", ""),
    ("price_divide_2", "dxHalfPrice", None),
    ("quantity_plus_discount", "dxSum", "cocB"),
    ("price_plus_discount_plus_TAX", "dxSumAll", None),
    ("count yes returned", "dxReturned", None),
    ("count yes closed", "dxClosed", "cocA"),
    ("count yes closed 2", "dxClosedCopy", None),
    ("remark", "dxRemark", None),
    ("tax", None, None),
    ("no such question", "dxNone", None),
]
_VALUES = ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in MAPPING_ROWS
)
MAPPING_SQL = (
    "SELECT name, data_element_id, COC, CAST(NULL AS VARCHAR(10)) AS CC, CAST(NULL AS VARCHAR(10)) AS Calcul "
    f"FROM (VALUES {_VALUES}) AS m(name, data_element_id, COC)"
)

# Derived columns in SQL, for the checks.
DERIVED_SQL = """*,
  quantity + discount AS quantity_plus_discount,
  price + discount + tax AS price_plus_discount_plus_tax,
  price / 2 AS price_divide_2, quantity / 2 AS quantity_divide_2,
  CAST(CASE WHEN returned IN ('1', 'yes') THEN 1 WHEN returned IN ('0', 'no') THEN 0 END AS INTEGER) AS "count yes returned",
  CAST(CASE WHEN closed IN ('1', 'yes') THEN 1 WHEN closed IN ('0', 'no') THEN 0 END AS INTEGER) AS "count yes closed",
  CAST(CASE WHEN closed IN ('1', 'yes') THEN 1 WHEN closed IN ('0', 'no') THEN 0 END AS INTEGER) AS "count yes closed 2\""""

_LONG = [
    "quantity",
    "price",
    "discount",
    "tax",
    "returned",
    "closed",
    "remark",
    "quantity_plus_discount",
    "price_plus_discount_plus_tax",
    "price_divide_2",
    "quantity_divide_2",
    "count yes returned",
    "count yes closed",
    "count yes closed 2",
]


def long_sql(source: str) -> str:
    """Unpivot of derived submissions, nulls kept."""
    return " UNION ALL ".join(
        f"SELECT export_id, periode, reference_externe, '{c}' AS data_element, CAST(\"{c}\" AS VARCHAR) AS value "
        f"FROM (SELECT {DERIVED_SQL} FROM ({source}))"
        for c in _LONG
    )


# White space trimmed by the checks: the characters that occur in the inputs.
BLANK = "trim({c}, concat(' ', chr(9))) = ''"


def points_sql(source: str) -> str:
    """Canonical points of submissions."""
    value = (
        f"CASE WHEN value IS NULL OR {BLANK.format(c='value')} OR lower(value) = 'nan' THEN NULL ELSE value END"
    )
    return f"""SELECT * FROM (
  SELECT periode AS PERIOD, reference_externe AS ORG_UNIT, data_element_id AS DX_UID,
    CASE WHEN COC IS NULL OR COC = '' THEN '{DEFAULT_COMBO}' ELSE COC END AS CATEGORY_OPTION_COMBO,
    '{DEFAULT_COMBO}' AS ATTRIBUTE_OPTION_COMBO, {value} AS VALUE, 'DATA_ELEMENT' AS DATA_TYPE
  FROM ({long_sql(source)}) l LEFT JOIN ({MAPPING_SQL}) m ON lower(l.data_element) = lower(m.name)
  WHERE periode <= {AS_OF.year * 100 + AS_OF.month} AND reference_externe IS NOT NULL
    AND NOT ({BLANK.format(c='reference_externe')})
    AND NOT starts_with(reference_externe, 'raw#') AND NOT starts_with(reference_externe, 'ssc'))
WHERE DX_UID IS NOT NULL AND VALUE IS NOT NULL"""


POINTS_SQL = points_sql(SUBMISSIONS_SQL)
EARLIER_POINTS_SQL = points_sql(EARLIER_SQL)
KEYS_SQL = "PERIOD, ORG_UNIT, DX_UID, CATEGORY_OPTION_COMBO, ATTRIBUTE_OPTION_COMBO"


def _form_rows(rows: DataFrame, form: list[str]) -> DataFrame:
    """The columns of a form. The unit comes out of an explode of one element: it is made once per row, as if it had been
    read, where each test on it would be pushed down into an evaluation of its own and make a method too long for the JVM
    to compile."""
    wide = rows.selectExpr(*form)
    return wide.select(*[F.explode(F.array(c)).alias(c) if c == RULES.unit else c for c in wide.columns])


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _form_rows(table(spark, sf_dir, "lineitem"), SUBMISSIONS)


def earlier_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _form_rows(table(spark, sf_dir, "lineitem").where(EARLIER_ROWS), EARLIER)


def mapping(spark: SparkSession) -> DataFrame:
    return spark.sql(MAPPING_SQL)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_points(submissions(spark, sf_dir), mapping(spark), FORM, RULES, AS_OF)


def earlier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_points(earlier_submissions(spark, sf_dir), mapping(spark), FORM, RULES, AS_OF)


def packs(spark: SparkSession, sf_dir: str) -> Packs | DataFrame:
    """The rows of ``points``, one per submission."""
    return packed_points(submissions(spark, sf_dir), mapping(spark), FORM, RULES, AS_OF)


def earlier_packs(spark: SparkSession, sf_dir: str) -> Packs | DataFrame:
    return packed_points(earlier_submissions(spark, sf_dir), mapping(spark), FORM, RULES, AS_OF)


# Orders as canonical points: one point per order, keys unique.
ORDER_POINTS = [
    f"{ORDER_PERIOD} AS PERIOD",
    "concat('C', o_custkey) AS ORG_UNIT",
    "concat('O', o_orderkey) AS DX_UID",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'cocLow' ELSE 'cocHigh' END AS CATEGORY_OPTION_COMBO",
    f"'{DEFAULT_COMBO}' AS ATTRIBUTE_OPTION_COMBO",
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20)) AS VALUE",
    "'DATA_ELEMENT' AS DATA_TYPE",
]
# Earlier: finished orders only, urgent ones at another value, some values null.
ORDER_EARLIER = [
    *ORDER_POINTS[:5],
    "CASE WHEN o_orderpriority = '1-URGENT' THEN '0' WHEN o_orderpriority = '2-HIGH' THEN NULL "
    "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20)) END AS VALUE",
    ORDER_POINTS[6],
]
ORDER_POINTS_SQL = f"SELECT {', '.join(ORDER_POINTS)} FROM orders"
ORDER_EARLIER_SQL = f"SELECT {', '.join(ORDER_EARLIER)} FROM orders WHERE o_orderstatus <> 'O'"


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_points(table(spark, sf_dir, "orders").selectExpr(*ORDER_POINTS))


def order_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_points(table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").selectExpr(*ORDER_EARLIER))


# Orders as payload rows with missing fields: open orders have no value, some lack a unit.
PAYLOAD = [
    "concat('O', o_orderkey) AS dataElement",
    f"{ORDER_PERIOD} AS period",
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'F' THEN NULL "
    "ELSE concat('C', o_custkey) END AS orgUnit",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'cocLow' ELSE 'cocHigh' END AS categoryOptionCombo",
    f"'{DEFAULT_COMBO}' AS attributeOptionCombo",
    "CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20)) "
    "ELSE concat(' ', chr(9)) END AS value",
]
PAYLOAD_SQL = f"SELECT {', '.join(PAYLOAD)} FROM orders"
CLASSES_SQL = (
    "SELECT *, CASE WHEN dataElement IS NULL OR period IS NULL OR orgUnit IS NULL OR categoryOptionCombo IS NULL "
    "OR attributeOptionCombo IS NULL THEN 'ignored' WHEN value IS NULL THEN 'delete' ELSE 'valid' END AS point_class "
    f"FROM ({PAYLOAD_SQL})"
)
# JSON text of one point, for the checks.
POINT_JSON_SQL = (
    """concat('{"dataElement":"', dataElement, '","period":', period, """
    """CASE WHEN orgUnit IS NULL THEN '' ELSE concat(',"orgUnit":"', orgUnit, '"') END, """
    """',"categoryOptionCombo":"', categoryOptionCombo, """
    """'","attributeOptionCombo":"', attributeOptionCombo, '","value":"', """
    f"CASE WHEN value IS NULL OR {BLANK.format(c='value')} "
    """THEN '","comment":"deleted value"}' ELSE concat(value, '"}') END)"""
)


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*PAYLOAD)


BATCH_SIZE = 50
_FIELDS = ["dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo", "value", "point_class"]
_DIGEST = f"md5(concat_ws(chr(1), {', '.join(f'coalesce(CAST({c} AS VARCHAR), chr(2))' for c in _FIELDS)}))"
BATCHED_SQL = f"""
  SELECT *, CAST((rn - 1) // {BATCH_SIZE} AS BIGINT) AS batch_no, CAST((rn - 1) % {BATCH_SIZE} AS INTEGER) AS batch_pos,
    concat(period, '-', point_class, '-', (rn - 1) // {BATCH_SIZE}) AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY period, point_class ORDER BY {_DIGEST}) AS rn
    FROM ({CLASSES_SQL}) WHERE point_class <> 'ignored')"""

# One response per batch of the payload rows; what it says depends on the month of the batch.
RESPONSE_BODY = (
    "CASE period % 100 "
    """WHEN 1 THEN concat('{"response":{"importCount":{"imported":', n_points, ',"ignored":1},"conflicts":[{"object":"o1","value":"bad unit","errorCode":"E1"}],"rejectedIndexes":[0,3,400]}}') """
    """WHEN 2 THEN concat('{"importCount":{"updated":', n_points, '},"response":{"importCount":{"imported":7,"updated":7}}}') """
    """WHEN 3 THEN 'gateway timeout' """
    """WHEN 4 THEN '{"status":"WARNING","importCount":{"ignored":2},"conflicts":[{"object":"o2","value":"late"},{"object":"o3","value":"closed"}],"errorReports":[{"message":"m1","errorCode":"E4"}]}' """
    """WHEN 5 THEN '{"message":"out of memory"}' """
    """WHEN 6 THEN '{}' """
    """WHEN 7 THEN NULL """
    """ELSE concat('{"status":"SUCCESS","importCount":{"imported":', n_points, ',"updated":0,"ignored":0,"deleted":0}}') END"""
)
STATUS_CODE = "CASE period % 100 WHEN 3 THEN 409 WHEN 4 THEN 409 WHEN 5 THEN 500 WHEN 7 THEN 503 ELSE 200 END"
RESPONSES = ["batch_id", "period", f"{STATUS_CODE} AS status_code", f"{RESPONSE_BODY} AS body"]
RESPONSES_SQL = (
    f"SELECT {', '.join(RESPONSES)} FROM (SELECT batch_id, period, count(*) AS n_points FROM ({BATCHED_SQL}) "
    "GROUP BY batch_id, period)"
)


def responses(batched: DataFrame) -> DataFrame:
    sizes = batched.groupBy("batch_id", "period").agg(F.count(F.lit(1)).alias("n_points"))
    return sizes.selectExpr(*RESPONSES)
