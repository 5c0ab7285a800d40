"""Alignment of two hierarchies made from customers and nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog.registry import query, table
from fieldledger.operators import hierarchy
from fieldledger.session import scratch_dir
from fieldledger.sources.landed import read_units

# Source: every customer is a unit under its nation; some fields are missing, some geometry is bad.
SOURCE = [
    "concat('C', c_custkey) AS id",
    "c_name AS name",
    "nullif(c_mktsegment, 'FURNITURE') AS shortName",
    "concat('20', CAST(10 + c_nationkey % 10 AS VARCHAR(2)), '-01-01') AS openingDate",
    "CASE WHEN c_acctbal < 0 THEN '2020-12-31' END AS closedDate",
    "CASE WHEN c_nationkey = 0 THEN NULL ELSE concat('N', c_nationkey) END AS parent_id",
    "CAST(2 AS INT) AS level",
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'no json' WHEN c_mktsegment = 'BUILDING' THEN NULL "
    """ELSE concat('{"type":"Point","coordinates":[', c_nationkey, ',', CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR(20)), ']}') END AS geometry""",
    "CAST(1 AS BIGINT) AS seq",
]
# Target: no customers of the last two nations; keys of geometry in another order; other levels; some
# names, dates and parents differ; an older row for household customers.
TARGET = [
    SOURCE[0],
    "CASE WHEN c_nationkey = 3 THEN concat(c_name, ' old') ELSE c_name END AS name",
    SOURCE[2],
    "CASE WHEN c_nationkey = 4 THEN '1999-01-01' ELSE concat('20', CAST(10 + c_nationkey % 10 AS VARCHAR(2)), '-01-01') END AS openingDate",
    "CASE WHEN c_acctbal < -500 THEN '2020-12-31' END AS closedDate",
    "CASE WHEN c_nationkey = 5 THEN 'N6' WHEN c_nationkey = 0 THEN NULL ELSE concat('N', c_nationkey) END AS parent_id",
    "CAST(3 AS INT) AS level",
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN NULL "
    """ELSE concat('{ "coordinates": [', c_nationkey, '.0, ', CASE WHEN c_nationkey = 7 THEN '1' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR(20)) END, '], "type": "Point"}') END AS geometry""",
    "CAST(2 AS BIGINT) AS seq",
]
TARGET_OLD = [SOURCE[0], "'renamed since' AS name", *TARGET[2:8], "CAST(1 AS BIGINT) AS seq"]
TARGET_ROWS = "c_nationkey < 23"


def _units(customers: DataFrame, columns: list[str]) -> DataFrame:
    units = customers.selectExpr(*columns)
    parent = F.when(F.col("parent_id").isNotNull(), F.struct(F.col("parent_id").alias("id")))
    return units.withColumn("parent", parent).drop("parent_id")


def source_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, those with a large balance twice, an older row of another name first."""
    customers = table(spark, sf_dir, "customer")
    older = _units(customers.where("c_acctbal > 9000"), [SOURCE[0], "'older' AS name", *SOURCE[2:8], "CAST(0 AS BIGINT) AS seq"])
    return _units(customers, SOURCE).unionByName(older)


def target_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where(TARGET_ROWS)
    older = customers.where("c_mktsegment = 'HOUSEHOLD'")
    return _units(customers, TARGET).unionByName(_units(older, TARGET_OLD))


def _select(columns: list[str], rows: str) -> str:
    return f"SELECT {', '.join(columns)} FROM customer WHERE {rows}"


_OLDER = [SOURCE[0], "'older' AS name", *SOURCE[2:8], "CAST(0 AS BIGINT) AS seq"]
SOURCE_SQL = f"{_select(SOURCE, 'true')} UNION ALL {_select(_OLDER, 'c_acctbal > 9000')}"
_LAST_TARGET_SQL = _select(TARGET, TARGET_ROWS)
_LAST_SOURCE_SQL = _select(SOURCE, "true")
_POINT = "CASE WHEN geometry LIKE '{%' THEN geometry END"
_DIFFERS = """(s.name IS DISTINCT FROM t.name OR s."shortName" IS DISTINCT FROM t."shortName"
  OR s."openingDate" IS DISTINCT FROM t."openingDate" OR s."closedDate" IS DISTINCT FROM t."closedDate"
  OR s.parent_id IS DISTINCT FROM t.parent_id
  OR json_extract(CASE WHEN s.geometry LIKE '{%' THEN s.geometry END, '$.coordinates[1]')
    IS DISTINCT FROM json_extract(CASE WHEN t.geometry LIKE '{%' THEN t.geometry END, '$.coordinates[1]'))"""
_CREATE_SQL = f"SELECT s.* FROM ({SOURCE_SQL}) s ANTI JOIN ({_LAST_TARGET_SQL}) t ON s.id = t.id"
_UPDATE_SQL = f"SELECT s.* FROM ({_LAST_SOURCE_SQL}) s JOIN ({_LAST_TARGET_SQL}) t ON s.id = t.id WHERE {_DIFFERS}"


def _unit_json(geometry: bool = True) -> str:
    shape = f"""CASE WHEN {_POINT} IS NULL THEN '' ELSE concat(',"geometry":', geometry) END""" if geometry else "''"
    return f"""concat('{{"id":"', id, '","name":"', name, '"',
  CASE WHEN "shortName" IS NULL THEN '' ELSE concat(',"shortName":"', "shortName", '"') END,
  ',"openingDate":"', "openingDate", '"',
  CASE WHEN "closedDate" IS NULL THEN '' ELSE concat(',"closedDate":"', "closedDate", '"') END,
  CASE WHEN parent_id IS NULL THEN '' ELSE concat(',"parent":{{"id":"', parent_id, '"}}') END, {shape}, '}}')"""


_COLUMNS = 'id, name, "shortName", "openingDate", "closedDate", parent_id, level'


@query(f"SELECT {_COLUMNS}, seq FROM ({_CREATE_SQL})")
def pyramid_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units the target lacks, repeated source rows included."""
    created = hierarchy.units_to_create(source_units(spark, sf_dir), target_units(spark, sf_dir))
    return created.withColumn("parent_id", F.col("parent.id")).drop("parent", "geometry")


@query(f"SELECT {_COLUMNS}, {_POINT} IS NOT NULL AS has_geometry FROM ({_UPDATE_SQL})")
def pyramid_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units in both hierarchies that differ; level and key order of geometry do not count."""
    source = hierarchy.prepare_units(source_units(spark, sf_dir))
    target = hierarchy.prepare_units(target_units(spark, sf_dir))
    return hierarchy.units_to_update(source, target).select(
        "id", "name", "shortName", "openingDate", "closedDate", F.col("parent.id").alias("parent_id"), "level",
        F.col("geometry").isNotNull().alias("has_geometry"),
    )


def _landed(units: DataFrame, label: str) -> DataFrame:
    """Units written as one JSON list per parent, older rows of an id first, and read again."""
    path = scratch_dir(units.sparkSession, label)
    row = F.struct(*[c for c in units.columns if c not in ("id", "seq")])
    # A list has the units of one parent, as one landed file would.
    listed = units.groupBy(F.coalesce("parent.id", F.lit("none")).alias("file")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "id", row.alias("row")))).alias("rows")
    )
    records = F.transform("rows", lambda r: F.struct(r["id"].alias("id"), *[r["row"][c].alias(c) for c in units.columns if c not in ("id", "seq")]))
    listed.select("file", F.to_json(records)).repartition("file").write.partitionBy("file").text(path)
    return read_units(units.sparkSession, path)


@query(f"SELECT {_COLUMNS}, {_POINT} IS NOT NULL AS has_geometry FROM ({_UPDATE_SQL})")
def landed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pyramid_update`` of units read from files, in which ids repeat; the last row of an id counts."""
    source = hierarchy.prepare_units(_landed(source_units(spark, sf_dir), "source"))
    target = hierarchy.prepare_units(_landed(target_units(spark, sf_dir), "target"))
    return hierarchy.units_to_update(source, target).select(
        "id", "name", "shortName", "openingDate", "closedDate", F.col("parent.id").alias("parent_id"), "level",
        F.col("geometry").isNotNull().alias("has_geometry"),
    )


@query(f"SELECT {_COLUMNS}, seq FROM ({_LAST_SOURCE_SQL})")
def last_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each unit."""
    last = hierarchy.last_units(source_units(spark, sf_dir))
    return last.withColumn("parent_id", F.col("parent.id")).drop("parent", "geometry")


@query(
    f"""SELECT id, seq, "shortName" IS NOT NULL AS valid, "shortName" IS NOT NULL AND parent_id IS NOT NULL AS strictly_valid
    FROM ({SOURCE_SQL})"""
)
def unit_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity with and without a parent."""
    return source_units(spark, sf_dir).select(
        "id",
        "seq",
        hierarchy.is_valid_unit(require_parent=False).alias("valid"),
        hierarchy.is_valid_unit().alias("strictly_valid"),
    )


def _actions_sql(geometry: bool = True) -> str:
    update = _UPDATE_SQL if geometry else _UPDATE_SQL.replace(
        _UPDATE_SQL[_UPDATE_SQL.index("  OR json_extract"):], ")"
    )
    json = _unit_json(geometry)
    valid = '"shortName" IS NOT NULL AND parent_id IS NOT NULL'
    return f"""SELECT 'CREATE' AS action, id AS ou_id, CASE WHEN {valid} THEN 'READY' ELSE 'NOTVALID' END AS status,
      CASE WHEN {valid} THEN {json} END AS payload FROM ({_CREATE_SQL})
    UNION ALL SELECT 'UPDATE', id, 'READY', concat('{{"organisationUnits":[', {json}, ']}}') FROM ({update})"""


@query(_actions_sql())
def alignment_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create and update actions with their JSON; invalid units are reported."""
    return hierarchy.alignment_actions(source_units(spark, sf_dir), target_units(spark, sf_dir), "2.40.1")


@query(_actions_sql(geometry=False))
def alignment_without_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a target version that stores no geometry."""
    return hierarchy.alignment_actions(source_units(spark, sf_dir), target_units(spark, sf_dir), "2.9")


# One response per sent action: updates of closed units fail.
_ANSWER = (
    """CASE WHEN action = 'UPDATE' AND payload LIKE '%closedDate%' THEN '{"status":"ERROR","response":{"errorCode":"E1"}}' """
    """ELSE '{"status":"OK","response":{"uid":"x"}}' END AS body"""
)
_REPORT_SQL = f"""SELECT action, CAST(CASE WHEN status = 'READY' THEN 200 END AS INTEGER) AS "statusCode",
    CASE WHEN status = 'NOTVALID' THEN status WHEN action = 'UPDATE' AND payload LIKE '%closedDate%' THEN 'ERROR' ELSE 'OK' END AS status,
    CASE WHEN status = 'NOTVALID' THEN NULL WHEN action = 'UPDATE' AND payload LIKE '%closedDate%' THEN '{{"errorCode":"E1"}}'
      ELSE '{{"uid":"x"}}' END AS response, ou_id FROM ({_actions_sql()})"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = alignment_actions(spark, sf_dir)
    # Repeated source rows are sent one by one, but the answer of a unit is the same each time.
    answers = actions.where("status = 'READY'").selectExpr("action", "ou_id", "200 AS status_code", _ANSWER).distinct()
    return hierarchy.alignment_report(actions, answers)


@query(_REPORT_SQL)
def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the actions and their responses."""
    return _report(spark, sf_dir)


@query(f"SELECT action, status, count(*) AS n_units FROM ({_REPORT_SQL}) GROUP BY ALL")
def alignment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome totals of an alignment."""
    return hierarchy.alignment_totals(_report(spark, sf_dir))
