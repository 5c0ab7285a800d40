"""Payload rows, batches and import responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog import inputs
from fieldledger.catalog.registry import query, table
from fieldledger.operators import batches, points, responses
from fieldledger.schemas import IMPORT_COUNTS
from fieldledger.plans.publish import plan_changes, point_report


@query(
    f"""SELECT DX_UID AS "dataElement", ORG_UNIT AS "orgUnit", PERIOD AS period,
      CATEGORY_OPTION_COMBO AS "categoryOptionCombo", VALUE AS value, DATA_TYPE AS "dataType",
      ATTRIBUTE_OPTION_COMBO AS "attributeOptionCombo" FROM ({inputs.POINTS_SQL})"""
)
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical points under their payload names."""
    return points.payload_rows(inputs.points(spark, sf_dir))


@query(inputs.CLASSES_SQL)
def point_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that are valid, to delete, or to ignore."""
    return points.classify_points(inputs.payload(spark, sf_dir))


@query(f"SELECT *, {inputs.POINT_JSON_SQL} AS point FROM ({inputs.PAYLOAD_SQL})")
def point_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as JSON; a null or blank value is sent as a deletion."""
    return points.point_json(inputs.payload(spark, sf_dir))


@query(f"SELECT *, {inputs.POINT_JSON_SQL} AS point FROM ({inputs.CLASSES_SQL}) WHERE point_class <> 'valid'")
def ignored_and_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the points that are not plainly published."""
    return point_report(inputs.payload(spark, sf_dir))


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_points(inputs.payload(spark, sf_dir), inputs.BATCH_SIZE)


@query(f"SELECT * EXCLUDE (rn) FROM ({inputs.BATCHED_SQL})")
def payload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in batches, with their position."""
    return _batched(spark, sf_dir)


# One large group whose batches are split by digest, with copies of one row in a third of it.
_LINE_POINTS = [
    "CASE WHEN l_linenumber <= 2 THEN 'hot' ELSE concat('L', l_orderkey, '-', l_linenumber) END AS dataElement",
    "CAST(year(l_shipdate) AS INT) // 100 AS period",
    "CASE WHEN l_linenumber <= 2 THEN 'U' ELSE concat('U', l_suppkey) END AS orgUnit",
    "CASE WHEN l_linenumber > 2 AND l_returnflag = 'N' THEN NULL ELSE 'v' END AS value",
]
_LINE_FIELDS = ["dataElement", "period", "orgUnit", "value"]
_LINE_DIGEST = f"md5(concat_ws(chr(1), {', '.join(f'coalesce(CAST({c} AS VARCHAR), chr(2))' for c in _LINE_FIELDS)}))"
_LINE_BATCH = 100


@query(
    f"""SELECT * EXCLUDE (rn), CAST((rn - 1) // {_LINE_BATCH} AS BIGINT) AS batch_no,
      CAST((rn - 1) % {_LINE_BATCH} AS INTEGER) AS batch_pos
    FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY {_LINE_DIGEST}) AS rn
      FROM (SELECT {', '.join(_LINE_POINTS)} FROM lineitem))"""
)
def batches_of_a_large_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of one group that takes many buckets, a third of it copies of one row."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(*[c.replace("//", "DIV") for c in _LINE_POINTS])
    named = lines.withColumn("period", F.col("period").cast("int"))
    return batches.number_batches(named, _LINE_BATCH, ["period"], bucket_rows=1_000)


@query(
    f"""SELECT batch_id, period, point_class, batch_no, count(*) AS n_points,
      concat('{{"dataValues":[', string_agg({inputs.POINT_JSON_SQL}, ',' ORDER BY batch_pos), ']}}') AS payload,
      'CREATE' AS "importStrategy", true AS "dryRun", true AS "preheatCache", true AS "skipAudit"
    FROM ({inputs.BATCHED_SQL}) GROUP BY ALL"""
)
def batch_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payload of each batch with its import options."""
    return batches.batch_payloads(_batched(spark, sf_dir), "CREATE", True)


@query(
    f"""SELECT PERIOD AS period, change_type, count(*) AS n_points, min(VALUE) AS min_value, max(VALUE) AS max_value
    FROM (SELECT c.*, 'new' AS change_type FROM ({inputs.ORDER_POINTS_SQL}) c ANTI JOIN ({inputs.ORDER_EARLIER_SQL}) p
        ON c.PERIOD = p.PERIOD AND c.ORG_UNIT = p.ORG_UNIT AND c.DX_UID = p.DX_UID
          AND c.CATEGORY_OPTION_COMBO = p.CATEGORY_OPTION_COMBO AND c.ATTRIBUTE_OPTION_COMBO = p.ATTRIBUTE_OPTION_COMBO
      UNION ALL SELECT c.*, 'changed' FROM ({inputs.ORDER_POINTS_SQL}) c JOIN ({inputs.ORDER_EARLIER_SQL}) p
        ON c.PERIOD = p.PERIOD AND c.ORG_UNIT = p.ORG_UNIT AND c.DX_UID = p.DX_UID
          AND c.CATEGORY_OPTION_COMBO = p.CATEGORY_OPTION_COMBO AND c.ATTRIBUTE_OPTION_COMBO = p.ATTRIBUTE_OPTION_COMBO
        WHERE c.VALUE <> p.VALUE) GROUP BY ALL"""
)
def planned_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload rows of a delta, summed up per period."""
    changes = plan_changes(inputs.order_points(spark, sf_dir), inputs.order_earlier(spark, sf_dir))
    return changes.groupBy("period", "change_type").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("value").alias("min_value"), F.max("value").alias("max_value")
    )


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.parse_responses(inputs.responses(_batched(spark, sf_dir)))


# Import counts of a response in SQL: the top-level object wins as a whole.
_COUNTS_SQL = ", ".join(
    f"CAST(coalesce(CASE WHEN json_extract(j, '$.importCount') IS NOT NULL "
    f"THEN json_extract(j, '$.importCount.{c}') ELSE json_extract(j, '$.response.importCount.{c}') END, '0') AS BIGINT) AS {c}"
    for c in ("imported", "updated", "ignored", "deleted")
)
_JSON_SQL = f"""SELECT batch_id, period, CAST(status_code AS INTEGER) AS status_code, body,
  CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM ({inputs.RESPONSES_SQL})"""


@query(
    f"SELECT batch_id, status_code, j IS NULL AS parse_failed, {_COUNTS_SQL} FROM ({_JSON_SQL})"
)
def response_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import counts of each response; a body that is no JSON has none."""
    counted = responses.counts_per_response(_parsed(spark, sf_dir))
    return counted.select("batch_id", "status_code", "parse_failed", *IMPORT_COUNTS)


@query(
    f"""SELECT CAST(sum(imported) AS BIGINT) AS imported, CAST(sum(updated) AS BIGINT) AS updated,
      CAST(sum(ignored) AS BIGINT) AS ignored, CAST(sum(deleted) AS BIGINT) AS deleted, count(*) AS responses,
      count(*) FILTER (j IS NULL) AS parse_failures
    FROM (SELECT j, {_COUNTS_SQL} FROM ({_JSON_SQL}))"""
)
def response_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import counts of a whole publish."""
    return responses.fold_counts(_parsed(spark, sf_dir))


@query(
    f"""SELECT batch_id, status_code, 'conflict' AS kind, 'bad unit' AS value, 'E1' AS "errorCode",
      '{{"object":"o1","value":"bad unit","errorCode":"E1"}}' AS detail FROM ({_JSON_SQL}) WHERE period % 100 = 1
    UNION ALL SELECT batch_id, status_code, 'conflict', value, NULL, concat('{{"object":"', object, '","value":"', value, '"}}')
      FROM ({_JSON_SQL}), (VALUES ('o2', 'late'), ('o3', 'closed')) AS v(object, value) WHERE period % 100 = 4
    UNION ALL SELECT batch_id, status_code, 'error_report', NULL, 'E4', '{{"message":"m1","errorCode":"E4"}}' FROM ({_JSON_SQL}) WHERE period % 100 = 4
    UNION ALL SELECT batch_id, status_code, 'request_error', NULL, CAST(status_code AS VARCHAR), NULL FROM ({_JSON_SQL}) WHERE period % 100 IN (3, 7)"""
)
def import_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts and error reports, at the top and nested, and requests without an answer."""
    return responses.import_errors(_parsed(spark, sf_dir))


@query(
    f"SELECT * EXCLUDE (rn) FROM ({inputs.BATCHED_SQL}) WHERE period % 100 = 1 AND batch_pos IN (0, 3)"
)
def rejected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points at the rejected positions of their batch; one position is out of range."""
    batched = _batched(spark, sf_dir)
    return responses.rejected_points(batched, responses.parse_responses(inputs.responses(batched)))


@query(
    f"""SELECT batch_id, status_code, CASE WHEN period % 100 = 5 THEN 'Import stopped by the server: out of memory'
      ELSE 'Import stopped by the server: HTTP 503 without a message' END AS message FROM ({_JSON_SQL}) WHERE period % 100 IN (5, 7)"""
)
def server_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that must stop a publish."""
    return responses.server_errors(_parsed(spark, sf_dir))


@query(
    f"""SELECT batch_id,
      CASE WHEN period % 100 IN (3, 6, 7) THEN 'parse_failed' WHEN period % 100 IN (4, 5) THEN 'failed' ELSE 'pushed' END AS outcome,
      CAST(CASE WHEN period % 100 IN (3, 6, 7) THEN 1 WHEN period % 100 = 4 THEN 2 ELSE 0 END AS INTEGER) AS push_errors,
      CAST(CASE WHEN period % 100 >= 8 THEN json_extract(j, '$.importCount.imported') ELSE '0' END AS BIGINT) AS imported,
      CAST(CASE WHEN period % 100 = 4 THEN 2 ELSE 0 END AS BIGINT) AS ignored
    FROM ({_JSON_SQL})"""
)
def completion_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of completion responses."""
    status = responses.completion_status(_parsed(spark, sf_dir))
    return status.select("batch_id", "outcome", "push_errors", "imported", "ignored")
