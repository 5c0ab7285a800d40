"""Completion of datasets: units are customers, registrations are orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from fieldledger.catalog import inputs
from fieldledger.catalog.registry import query, table
from fieldledger.functions.periods import months_between
from fieldledger.operators import completion
from fieldledger.session import scratch_dir
from fieldledger.sources.landed import explode_registrations, read_registrations

# Every order registers its customer for its month; later orders of the month are repeats.
REGISTRATIONS = [
    "concat('C', o_custkey) AS organisationUnit",
    f"CAST({inputs.ORDER_PERIOD} AS VARCHAR(6)) AS period",
    "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus = 'F' END AS completed",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS date",
    "'dsSource' AS dataSet",
    "o_orderkey AS seq",
]
REGISTRATIONS_SQL = f"SELECT {', '.join(REGISTRATIONS)} FROM orders"
# Requested: every customer for each month of the orders.
REQUESTED_SQL = """SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS PERIOD, concat('C', c_custkey) AS ORG_UNIT
  FROM customer, (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
    INTERVAL 1 MONTH)) AS m FROM orders)"""
PROCESSED = [f"{inputs.ORDER_PERIOD} AS PERIOD", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('C', o_custkey) END AS ORG_UNIT"]
PROCESSED_ROWS = "o_orderpriority = '1-URGENT'"
PROCESSED_SQL = f"SELECT {', '.join(PROCESSED)} FROM orders WHERE {PROCESSED_ROWS}"


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*REGISTRATIONS)


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    months = F.explode(months_between(F.lit(dates["a"].date()), F.lit(dates["b"].date()))).alias("PERIOD")
    units = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("ORG_UNIT"))
    # A small table is one scan task; a number of its own keeps the parts apart that the months multiply.
    parts = 4 * spark.sparkContext.defaultParallelism
    return units.repartition(parts, "ORG_UNIT").select(months, "ORG_UNIT")


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(PROCESSED_ROWS).selectExpr(*PROCESSED)


_FIRST_SQL = f"""SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (
    PARTITION BY "organisationUnit", period ORDER BY seq) AS rn FROM ({REGISTRATIONS_SQL})) WHERE rn = 1"""


@query(f"SELECT period, \"organisationUnit\", completed, date, \"dataSet\" FROM ({_FIRST_SQL})")
def first_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first registration of each unit and period."""
    return completion.first_registrations(registrations(spark, sf_dir))


@query(f"SELECT \"organisationUnit\", period, completed, date, \"dataSet\" FROM ({REGISTRATIONS_SQL})")
def registration_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations taken out of the documents they arrive in."""
    one = registrations(spark, sf_dir)
    row = F.struct("organisationUnit", "period", "completed", "date", "dataSet")
    documents = one.select(F.array(row).alias("completeDataSetRegistrations"), "seq")
    return explode_registrations(documents, F.col("seq")).drop("seq")


@query(
    f"""SELECT "organisationUnit", period, completed, date, "dataSet", doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY seq) AS INTEGER) AS place
    FROM (SELECT *, CAST(seq % 20 AS INTEGER) AS doc FROM ({REGISTRATIONS_SQL}))"""
)
def registration_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents of many registrations each, read in pieces; their order is kept."""
    path = scratch_dir(spark, "documents")
    every = registrations(spark, sf_dir).withColumn("doc", (F.col("seq") % 20).cast("int"))
    row = F.struct("organisationUnit", "period", "completed", "date", "dataSet")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", row.alias("row")))), lambda x: x["row"])
    documents = every.groupBy("doc").agg(F.to_json(F.struct(ordered.alias("completeDataSetRegistrations"))).alias("value"))
    documents.write.partitionBy("doc").text(path)
    read = read_registrations(spark, path).withColumn("doc", F.regexp_extract("seq._file", "doc=([0-9]+)", 1).cast("int"))
    place = F.row_number().over(W.partitionBy("doc").orderBy("seq"))
    return read.withColumn("place", place).drop("seq")


_UNPROCESSED_SQL = f"""SELECT r.* FROM ({REQUESTED_SQL}) r ANTI JOIN ({PROCESSED_SQL}) p
  ON r.PERIOD = p.PERIOD AND r.ORG_UNIT = p.ORG_UNIT"""


@query(_UNPROCESSED_SQL)
def unprocessed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested units that the log lacks."""
    return completion.unprocessed_units(requested(spark, sf_dir), processed(spark, sf_dir))


def _plan_sql(found: str) -> str:
    return f"""SELECT PERIOD, ORG_UNIT, completed, date, outcome, CASE WHEN outcome = 'ready' THEN concat(
      '{{"completeDataSetRegistrations":[{{"organisationUnit":"', ORG_UNIT, '","period":"', PERIOD, '","completed":', completed,
      ',"date":"', date, '","dataSet":"dsTarget"}}]}}') END AS payload
    FROM (SELECT u.*, completed, date, CASE WHEN f."organisationUnit" IS NULL THEN 'no_completion'
        WHEN date IS NULL OR completed IS NULL THEN 'missing_keys' ELSE 'ready' END AS outcome
      FROM ({_UNPROCESSED_SQL}) u LEFT JOIN ({found}) f
        ON f."organisationUnit" = u.ORG_UNIT AND CAST(f.period AS INTEGER) = u.PERIOD)"""


@query(_plan_sql(_FIRST_SQL))
def completion_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to send for each unprocessed unit."""
    return completion.completion_plan(
        requested(spark, sf_dir), processed(spark, sf_dir), registrations(spark, sf_dir), "dsTarget"
    )


_TWO_SOURCES_SQL = f"""SELECT * EXCLUDE (rn, seq, rank) FROM (SELECT *, row_number() OVER (
    PARTITION BY "organisationUnit", period ORDER BY rank, seq) AS rn FROM (
      SELECT *, 0 AS rank FROM ({REGISTRATIONS_SQL}) WHERE completed
      UNION ALL SELECT *, 1 FROM ({REGISTRATIONS_SQL}) WHERE NOT completed OR completed IS NULL)) WHERE rn = 1"""


@query(_plan_sql(_TWO_SOURCES_SQL))
def completion_plan_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations fetched for single units count only where the common table has none."""
    every = registrations(spark, sf_dir)
    return completion.completion_plan(
        requested(spark, sf_dir),
        processed(spark, sf_dir),
        every.where("completed"),
        "dsTarget",
        unit_registrations=every.where("NOT completed OR completed IS NULL"),
    )


# Responses: those for completed units succeed, others are in conflict twice. Units of every February get none;
# in the queries below, those of one month.
_STATUS = [
    "PERIOD",
    "ORG_UNIT",
    "CASE WHEN completed THEN 'pushed' ELSE 'failed' END AS outcome",
    "CAST(CASE WHEN completed THEN 0 ELSE 2 END AS INT) AS push_errors",
]
_STATUS_ROWS = "outcome = 'ready' AND PERIOD % 100 <> 2"
_OUTCOMES_SQL = f"""SELECT PERIOD, ORG_UNIT, CASE WHEN outcome <> 'ready' THEN outcome
    WHEN PERIOD % 100 = 2 THEN 'parse_failed' WHEN completed THEN 'pushed' ELSE 'failed' END AS outcome,
    CAST(CASE WHEN outcome = 'missing_keys' THEN 1 WHEN outcome <> 'ready' THEN 0 WHEN PERIOD % 100 = 2 THEN 1
      WHEN completed THEN 0 ELSE 2 END AS INTEGER) AS push_errors FROM ({_plan_sql(_FIRST_SQL)})"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = completion_plan(spark, sf_dir)
    return completion.completion_outcomes(plan, plan.where(_STATUS_ROWS).selectExpr(*_STATUS))


@query(_OUTCOMES_SQL)
def completion_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final outcome of each unit."""
    return _outcomes(spark, sf_dir)


@query(
    f"""SELECT outcome, count(*) AS n_units, CAST(sum(push_errors) AS BIGINT) AS push_errors
    FROM ({_OUTCOMES_SQL}) GROUP BY outcome"""
)
def outcome_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and push errors per outcome."""
    return completion.outcome_tallies(_outcomes(spark, sf_dir))


@query(
    f"""SELECT PERIOD, ORG_UNIT FROM ({PROCESSED_SQL})
    UNION SELECT PERIOD, ORG_UNIT FROM ({_OUTCOMES_SQL}) WHERE outcome IN ('pushed', 'no_completion')"""
)
def processed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after the run, units without a completion included."""
    new = completion.newly_processed(_outcomes(spark, sf_dir), mark_uncompleted=True)
    return completion.merge_processed(processed(spark, sf_dir), new)


_ANSWERED_ROWS = "outcome = 'ready' AND PERIOD <> 199701"
_ANSWERED_SQL = f"""SELECT PERIOD, ORG_UNIT, CASE WHEN outcome <> 'ready' THEN outcome
    WHEN PERIOD = 199701 THEN 'parse_failed' WHEN completed THEN 'pushed' ELSE 'failed' END AS outcome,
    CAST(CASE WHEN outcome = 'missing_keys' THEN 1 WHEN outcome <> 'ready' THEN 0 WHEN PERIOD = 199701 THEN 1
      WHEN completed THEN 0 ELSE 2 END AS INTEGER) AS push_errors FROM ({_plan_sql(_FIRST_SQL)})"""


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = completion_plan(spark, sf_dir)
    return completion.completion_outcomes(plan, plan.where(_ANSWERED_ROWS).selectExpr(*_STATUS))


@query(_ANSWERED_SQL)
def answered_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final outcome of each unit, where the units of all months but one are answered."""
    return _answered(spark, sf_dir)


@query(
    f"""SELECT outcome, count(*) AS n_units, CAST(sum(push_errors) AS BIGINT) AS push_errors
    FROM ({_ANSWERED_SQL}) GROUP BY outcome"""
)
def answered_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and push errors per outcome, where the units of all months but one are answered."""
    return completion.outcome_tallies(_answered(spark, sf_dir))


@query(
    f"""SELECT PERIOD, ORG_UNIT FROM ({PROCESSED_SQL})
    UNION SELECT PERIOD, ORG_UNIT FROM ({_ANSWERED_SQL}) WHERE outcome IN ('pushed', 'no_completion')"""
)
def answered_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after a run whose units are answered in all months but one."""
    new = completion.newly_processed(_answered(spark, sf_dir), mark_uncompleted=True)
    return completion.merge_processed(processed(spark, sf_dir), new)
