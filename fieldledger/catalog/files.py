"""Jobs that write datasets and read them back: stages, extracts, publish cycles and streams."""

from __future__ import annotations

import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog import inputs
from fieldledger.catalog.completion import registrations, requested
from fieldledger.catalog.facts import _event_values
from fieldledger.catalog.registry import query, table
from fieldledger.functions.periods import distinct_periods
from fieldledger.operators.reconcile import stage_gate
from fieldledger.plans import completion as completion_plan
from fieldledger.plans.extract import extract
from fieldledger.plans.ingest import ingest
from fieldledger.plans.publish import PublishPaths, prepare_publish, settle_publish
from fieldledger.plans.quality import report_non_numeric
from fieldledger.plans.transform import transform
from fieldledger.schemas import POINT, POINT_KEYS
from fieldledger.session import scratch_dir
from fieldledger.sinks.audit import read_counts, write_counts
from fieldledger.sinks.stages import replace_parquet, write_csv, write_stage, write_table
from fieldledger.sources.landed import read_mapping, read_processed
from fieldledger.sources.paths import file_system, list_periods
from fieldledger.sources.tabular import read_csv, read_csv_fetches, read_flat_stage, read_stage
from fieldledger.streaming.incoming import last_epoch, publish_incoming, read_pending, retry_pending

_ORDERS = ["o_orderkey", "o_totalprice", "o_orderstatus", f"{inputs.ORDER_PERIOD} AS PERIOD"]


@query(
    f"""WITH o AS (SELECT {', '.join(_ORDERS)} FROM orders)
    SELECT * FROM o WHERE PERIOD NOT IN (SELECT PERIOD FROM o WHERE PERIOD BETWEEN 199601 AND 199612 AND o_orderstatus = 'F')
    UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderstatus, PERIOD FROM o
      WHERE PERIOD BETWEEN 199601 AND 199612 AND o_orderstatus = 'F'"""
)
def stage_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a stage, replace the partitions of one year, and read all back; rows without period go."""
    path = scratch_dir(spark, "stage")
    orders = table(spark, sf_dir, "orders").selectExpr(*_ORDERS)
    nowhere = orders.withColumn("PERIOD", F.lit(None).cast("int"))
    write_stage(orders.unionByName(nowhere), path)
    finished = orders.where("PERIOD BETWEEN 199601 AND 199612 AND o_orderstatus = 'F'")
    write_stage(finished.withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    write_stage(finished.where("false"), path)
    return read_stage(spark, path)


@query(
    f"SELECT o_orderkey, o_totalprice, o_orderstatus, {inputs.ORDER_PERIOD} AS PERIOD FROM orders "
    f"WHERE {inputs.ORDER_PERIOD} IN (199605, 200003)"
)
def stage_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage sorted by every column, read for two periods only."""
    path = scratch_dir(spark, "stage")
    write_stage(table(spark, sf_dir, "orders").selectExpr(*_ORDERS), path, ordered=True)
    return read_stage(spark, path, periods=[199605, 200003])


@query(f"SELECT {', '.join(_ORDERS)} FROM orders")
def csv_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage in CSV, its types found again on reading."""
    path = scratch_dir(spark, "stage")
    write_stage(table(spark, sf_dir, "orders").selectExpr(*_ORDERS), path, "csv")
    return read_stage(spark, path, "csv")


_ANSWERS = """CASE l_returnflag WHEN 'N' THEN CAST(l_orderkey AS VARCHAR(20)) WHEN 'A' THEN concat(l_orderkey, '.50')
  ELSE concat('n/a ', l_linenumber) END"""


@query(f"SELECT l_orderkey, l_linenumber, {_ANSWERS} AS answer FROM lineitem")
def csv_late_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question answered with whole numbers in a first file, with decimals and texts in a later one: no cell is lost."""
    first, later = scratch_dir(spark, "first"), scratch_dir(spark, "later")
    answers = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_ANSWERS} AS answer")
    write_csv(answers.where("answer RLIKE '^[0-9]+$'"), first)
    write_csv(answers.where("NOT answer RLIKE '^[0-9]+$'"), later)
    fetched = read_csv_fetches(spark, [first, later])
    return fetched.select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), "answer")


_DRIFT = {
    "PERIOD < 199700": "o_orderkey, o_custkey AS x, o_orderstatus AS q_a",
    "PERIOD BETWEEN 199700 AND 199899": "o_orderkey, o_custkey + CAST(0.5 AS DOUBLE) AS x, o_orderkey % 7 AS q_b",
    "PERIOD >= 199900": "o_orderkey, 'C' || o_custkey AS x",
}


@query(
    f"""WITH o AS (SELECT *, {inputs.ORDER_PERIOD} AS PERIOD FROM orders)
    SELECT o_orderkey, CASE WHEN PERIOD < 199700 THEN CAST(o_custkey AS VARCHAR)
        WHEN PERIOD < 199900 THEN concat(o_custkey, '.5') ELSE concat('C', o_custkey) END AS x,
      CASE WHEN PERIOD < 199700 THEN o_orderstatus END AS q_a,
      CASE WHEN PERIOD BETWEEN 199700 AND 199899 THEN o_orderkey % 7 END AS q_b, PERIOD FROM o"""
)
def stage_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage whose periods were written with other columns and other types; all rows and cells come back."""
    path = scratch_dir(spark, "stage")
    orders = table(spark, sf_dir, "orders").selectExpr("*", f"{inputs.ORDER_PERIOD} AS PERIOD")
    for periods, columns in _DRIFT.items():
        write_stage(orders.where(periods).selectExpr(*columns.split(", "), "PERIOD"), path)
    return read_stage(spark, path)


@query("SELECT doc_id, text, lang, n_chars FROM documents")
def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with quotes and line breaks inside cells, whole texts."""
    path = scratch_dir(spark, "texts")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"), path)
    return read_csv(spark, path)


@query(
    """SELECT 'DATA_ELEMENT' AS DATA_TYPE, event_type AS DX_UID, CAST(strftime(ts, '%Y%m') AS INTEGER) AS PERIOD,
      concat('U', user_id) AS ORG_UNIT, 'coc' AS CATEGORY_OPTION_COMBO, 'aoc' AS ATTRIBUTE_OPTION_COMBO,
      CAST(NULL AS VARCHAR) AS RATE_TYPE, 'AGGREGATED' AS DOMAIN_TYPE, CAST(value AS VARCHAR) AS VALUE
    FROM events WHERE event_type IN ('click', 'view')"""
)
def extract_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract by period: a first run, one that must not touch what is there, and a replacing one."""
    landed, out = scratch_dir(spark, "landed"), scratch_dir(spark, "extract")
    values = _event_values(spark, sf_dir).withColumnRenamed("event_type", "dataElement")
    values = values.withColumns({"categoryOptionCombo": F.lit("coc"), "attributeOptionCombo": F.lit("aoc")})
    values.write.parquet(landed)
    users = values.select("orgUnit").distinct()
    periods = [202312, 202401, 202402]
    extract(spark, landed, out, "DATA_ELEMENT", ["click"], users, periods)
    extract(spark, landed, out, "DATA_ELEMENT", ["error"], users, periods, "DOWNLOAD_NEW")
    extract(spark, landed, out, "DATA_ELEMENT", ["click", "view"], users, periods)
    return read_stage(spark, out)


def _extracted_sql(data_type: str, rate: str) -> str:
    return f"""SELECT '{data_type}' AS DATA_TYPE, event_type AS DX_UID, CAST(strftime(ts, '%Y%m') AS INTEGER) AS PERIOD,
      concat('U', user_id) AS ORG_UNIT, CAST(NULL AS VARCHAR) AS CATEGORY_OPTION_COMBO, CAST(NULL AS VARCHAR) AS ATTRIBUTE_OPTION_COMBO,
      {rate} AS RATE_TYPE, 'AGGREGATED' AS DOMAIN_TYPE, CAST(value AS VARCHAR) AS VALUE FROM events"""


def _extracted(spark: SparkSession, sf_dir: str, data_type: str, suffix: str) -> DataFrame:
    """Landed analytics values of all event types as JSON, extracted period by period and read back."""
    landed, out = scratch_dir(spark, "landed"), scratch_dir(spark, "extract")
    values = _event_values(spark, sf_dir).withColumnsRenamed({"event_type": "dx", "period": "pe", "orgUnit": "ou"})
    values.withColumn("dx", F.concat("dx", F.lit(suffix))).write.json(landed)
    products = values.select(F.concat("dx", F.lit(suffix)).alias("dx")).distinct()
    periods = [r[0] for r in values.select("pe").distinct().collect()]
    extract(spark, landed, out, data_type, products, values.select("ou").distinct(), periods, file_format="json")
    return read_stage(spark, out)


@query(_extracted_sql("INDICATOR", "CAST(NULL AS VARCHAR)"))
def extract_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator values from landed JSON to standard points."""
    return _extracted(spark, sf_dir, "INDICATOR", "")


@query(_extracted_sql("REPORTING_RATE", "'ACTUAL_REPORTS'"))
def extract_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reporting rates from landed JSON to standard points; the rate is parted from the dataset."""
    return _extracted(spark, sf_dir, "REPORTING_RATE", ".ACTUAL_REPORTS")


@query(
    f"""WITH o AS (SELECT {', '.join(_ORDERS)} FROM orders)
    SELECT 'one' AS choice, * FROM o WHERE PERIOD = 199605 UNION ALL SELECT 'some', * FROM o WHERE PERIOD IN (199605, 199712)
    UNION ALL SELECT 'all', * FROM o"""
)
def flat_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage files with the period at the end of their names: one period, some, and all."""
    path = scratch_dir(spark, "flat")
    write_stage(table(spark, sf_dir, "orders").selectExpr(*_ORDERS), path)
    for period in list_periods(spark, path):
        old, fs = file_system(spark, f"{path}/PERIOD={period}")
        fs.rename(old, file_system(spark, f"{path}/orders_v2_{period}.parquet")[0])
    chosen = {"one": {"only": 199605}, "some": {"periods": [199605, 199712]}, "all": {}}
    parts = [read_flat_stage(spark, path, **which).select(F.lit(name).alias("choice"), "*") for name, which in chosen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT concat('Q', p_partkey) AS name, nullif(p_type, 'PROMO') AS data_element_id, CAST(p_size AS VARCHAR) AS "COC",
      CAST(NULL AS VARCHAR) AS "CC", CAST(NULL AS VARCHAR) AS "Calcul" FROM part"""
)
def mapping_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mappings landed as JSON lists, one per file, with fields that are not asked for."""
    path = scratch_dir(spark, "mapping")
    part = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 8).alias("file"),
        F.concat(F.lit("Q"), "p_partkey").alias("name"),
        F.expr("nullif(p_type, 'PROMO')").alias("data_element_id"),
        F.col("p_size").cast("string").alias("COC"),
        F.col("p_name").alias("note"),
    )
    lists = part.groupBy("file").agg(F.to_json(F.collect_list(F.struct("name", "data_element_id", "COC", "note"))).alias("value"))
    lists.write.partitionBy("file").text(path)
    return read_mapping(spark, path)


@query("SELECT c_custkey, c_acctbal FROM customer")
def replaced_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset replaced as a whole, and left alone by a job that fails."""
    path = scratch_dir(spark, "dataset")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    replace_parquet(customers.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.lit(0.0)), path)
    replace_parquet(customers, path)
    broken = F.when(F.col("c_custkey") < 0, F.col("c_acctbal")).otherwise(F.raise_error(F.lit("a job that fails")))
    with suppress(Exception):
        replace_parquet(customers.withColumn("c_acctbal", broken.cast("double")), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def table_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced, then appended to with its columns in another order."""
    name = f"export_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(orders.where("o_orderstatus = 'P'"), name)
    write_table(orders.where("o_orderstatus = 'F'"), name)
    write_table(orders.where("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey", "o_custkey"), name, "append")
    return spark.table(name)


@query(inputs.POINTS_SQL)
def form_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CSV to raw stage to transformed stage, read back as points."""
    landed, raw, done = (scratch_dir(spark, name) for name in ("landed", "raw", "transformed"))
    write_csv(inputs.submissions(spark, sf_dir), landed)
    ingest(spark, [landed], raw)
    transform(spark, raw, done, inputs.mapping(spark), inputs.FORM, inputs.RULES, inputs.AS_OF)
    return read_stage(spark, done, schema=POINT)


_PUBLISH_KEYS = " AND ".join(f"c.{k} = r.{k}" for k in POINT_KEYS)
_CYCLE_SQL = f"""WITH c AS ({inputs.ORDER_POINTS_SQL}), p AS ({inputs.ORDER_EARLIER_SQL}),
    r AS (SELECT c.* FROM c WHERE (PERIOD % 100 = 1 AND CATEGORY_OPTION_COMBO = 'cocLow' OR PERIOD % 100 IN (2, 3)) AND NOT EXISTS (
      SELECT 1 FROM p r WHERE {_PUBLISH_KEYS} AND (c.VALUE = r.VALUE OR r.VALUE IS NULL)))
  SELECT c.* FROM c ANTI JOIN r ON {_PUBLISH_KEYS}
  UNION ALL SELECT c.* FROM p c SEMI JOIN r ON {_PUBLISH_KEYS}"""


@query(_CYCLE_SQL)
def publish_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta, batches, responses that reject some points, and the snapshot that follows.

    Batches of February are never answered and those of March fail. Before it a dry run, which must leave the
    snapshot alone.
    """
    done, pushed, out = (scratch_dir(spark, name) for name in ("transformed", "pushed", "out"))
    write_stage(inputs.order_points(spark, sf_dir), done)
    write_stage(inputs.order_earlier(spark, sf_dir), pushed)
    for dry_run in (True, False):
        paths = PublishPaths(f"{out}/dry={dry_run}")
        prepare_publish(spark, done, pushed, paths, size=inputs.BATCH_SIZE, dry_run=dry_run)
        rejected = (F.col("period") % 100 == 1) & (F.col("categoryOptionCombo") == "cocLow")
        # The positions of one batch are at most its size.
        positions = F.collect_list(F.when(rejected, F.col("batch_pos"))).alias("rejectedIndexes")
        failed = F.min("period") % 100 == 3
        answered = spark.read.parquet(paths.points).where("period % 100 <> 2").groupBy("batch_id")
        good = F.to_json(F.struct(F.struct("rejectedIndexes").alias("response")))
        replies = answered.agg(positions, failed.alias("failed")).select(
            "batch_id",
            F.when(F.col("failed"), 409).otherwise(200).alias("status_code"),
            F.when(F.col("failed"), '{"status":"ERROR"}').otherwise(good).alias("body"),
        )
        settle_publish(spark, done, pushed, paths, replies, dry_run)
    return read_stage(spark, pushed, schema=POINT)


_MONTH = "PERIOD % 100"
_DONE_PERIODS = "PERIOD % 2 = 0"


@query(
    f"""WITH t AS (SELECT PERIOD, ORG_UNIT, count(*) AS n FROM ({inputs.ORDER_POINTS_SQL}) GROUP BY ALL),
    p AS (SELECT PERIOD, ORG_UNIT, count(*) AS n FROM ({inputs.ORDER_POINTS_SQL})
      WHERE {_DONE_PERIODS} AND NOT (PERIOD % 100 = 6 AND CATEGORY_OPTION_COMBO = 'cocHigh') GROUP BY ALL)
    SELECT t.PERIOD, count(*) AS n_units, CAST(sum(t.n) AS BIGINT) AS n_transformed, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS n_pushed,
      coalesce(sum(p.n), 0) = 0 AS process
    FROM t LEFT JOIN p USING (PERIOD, ORG_UNIT) GROUP BY t.PERIOD"""
)
def stored_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that runs store: all periods transformed, some of them published, and the periods still to push."""
    done, pushed, out, audit = (scratch_dir(spark, n) for n in ("transformed", "pushed", "out", "audit"))
    points = inputs.order_points(spark, sf_dir)
    write_stage(points, done)
    periods = list_periods(spark, done)
    write_counts(points, audit, "transformed", periods)
    chosen = [p for p in periods if p % 2 == 0]
    paths = PublishPaths(out)
    prepare_publish(spark, done, pushed, paths, periods=chosen, dry_run=False)
    batched = spark.read.parquet(paths.points)
    refused = (F.col("period") % 100 == 6) & (F.col("categoryOptionCombo") == "cocHigh")
    # The positions of one batch are at most its size.
    positions = F.collect_list(F.when(refused, F.col("batch_pos"))).alias("rejectedIndexes")
    replies = batched.groupBy("batch_id").agg(positions).select(
        "batch_id", F.lit(200).alias("status_code"), F.to_json(F.struct("rejectedIndexes")).alias("body")
    )
    settle_publish(spark, done, pushed, paths, replies, False, periods=chosen, audit_path=audit)
    counts = read_counts(spark, audit)
    per_period = counts.groupBy(F.col("period").alias("_period")).agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("transformed_count").alias("n_transformed"), F.sum("pushed_count").alias("n_pushed")
    )
    gate = stage_gate(distinct_periods(points), counts, "pushed")
    return gate.join(per_period, gate["PERIOD"] == per_period["_period"]).select("PERIOD", "n_units", "n_transformed", "n_pushed", "process")


# What a file brings, and the answers to the batches of each run: months without one, and what is rejected of the others.
_LATER_ROWS = f"{_MONTH} NOT IN (4, 5)"
_UNANSWERED = {0: "period % 100 IN (2, 4)", 1: "period % 100 = 2"}
_REJECTED = {
    0: "period % 100 IN (1, 5) AND categoryOptionCombo = 'cocLow'",
    1: "period % 100 = 5 AND categoryOptionCombo = 'cocLow' OR period % 100 = 6 AND categoryOptionCombo = 'cocHigh'",
}


def _replies(epoch: int, paths: PublishPaths) -> DataFrame:
    """Responses of two runs; batches of March fail in the first."""
    batched = SparkSession.getActiveSession().read.parquet(paths.points).where(f"NOT ({_UNANSWERED[epoch]})")
    # The positions of one batch are at most its size.
    positions = F.collect_list(F.when(F.expr(_REJECTED[epoch]), F.col("batch_pos"))).alias("rejectedIndexes")
    failed = F.min("period") % 100 == (3 if epoch == 0 else -1)
    good = F.to_json(F.struct(F.struct("rejectedIndexes").alias("response")))
    return batched.groupBy("batch_id").agg(positions, failed.alias("failed")).select(
        "batch_id",
        F.when(F.col("failed"), 409).otherwise(200).alias("status_code"),
        F.when(F.col("failed"), '{"status":"ERROR"}').otherwise(good).alias("body"),
    )


@query(
    f"""SELECT * FROM ({inputs.ORDER_POINTS_SQL})
      WHERE {_MONTH} NOT IN (2, 4, 5, 6) OR ({_MONTH} = 6 AND CATEGORY_OPTION_COMBO = 'cocLow')
    UNION ALL SELECT * FROM ({inputs.ORDER_EARLIER_SQL}) WHERE VALUE IS NOT NULL
      AND ({_MONTH} = 4 OR ({_MONTH} IN (5, 6) AND CATEGORY_OPTION_COMBO = 'cocHigh'))"""
)
def incremental_settle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files published in two runs whose batches are rejected, fail or get no answer.

    February is never answered, April only on the second run, whose file lacks it; what is rejected of May is lacking there
    as well, and of June the values posted first stay.
    """
    landing, pushed, out, state = (scratch_dir(spark, n) for n in ("landing", "pushed", "out", "state"))
    later = inputs.order_points(spark, sf_dir).where(_LATER_ROWS)
    for points in (inputs.order_earlier(spark, sf_dir), later):
        points.write.mode("append").parquet(landing)
        publish_incoming(
            spark, landing, POINT, lambda df: df, pushed, out, state, _replies, inputs.BATCH_SIZE, files_per_batch=None
        ).awaitTermination()
    return read_stage(spark, pushed, schema=POINT)


def _accepted(epoch: int, paths: PublishPaths) -> DataFrame:
    """A good answer to every batch."""
    batched = SparkSession.getActiveSession().read.parquet(paths.points)
    good = (F.lit(200).alias("status_code"), F.lit('{"status":"SUCCESS"}').alias("body"))
    return batched.select("batch_id").distinct().select("batch_id", *good)


@query(
    f"""SELECT * FROM ({inputs.ORDER_POINTS_SQL}) WHERE {_LATER_ROWS}
    UNION ALL SELECT * FROM ({inputs.ORDER_EARLIER_SQL}) WHERE VALUE IS NOT NULL AND NOT ({_LATER_ROWS})"""
)
def incremental_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files published as they arrive in two runs; what the second lacks stays as the first had it."""
    landing, pushed, out, state = (scratch_dir(spark, n) for n in ("landing", "pushed", "out", "state"))
    for points in (inputs.order_earlier(spark, sf_dir), inputs.order_points(spark, sf_dir).where(_LATER_ROWS)):
        points.write.mode("append").parquet(landing)
        # The files of a run share no keys.
        publish_incoming(
            spark, landing, POINT, lambda df: df, pushed, out, state, _accepted, files_per_batch=None
        ).awaitTermination()
    return read_stage(spark, pushed, schema=POINT)


@query(
    f"""SELECT 'posted' AS state, * FROM ({inputs.ORDER_POINTS_SQL})
      WHERE {_MONTH} NOT IN (2, 4) AND NOT ({_MONTH} IN (1, 5) AND CATEGORY_OPTION_COMBO = 'cocLow')
    UNION ALL SELECT 'posted', * FROM ({inputs.ORDER_POINTS_SQL}) WHERE {_MONTH} = 4
      OR {_MONTH} = 1 AND CATEGORY_OPTION_COMBO = 'cocLow'
    UNION ALL SELECT 'pending', * FROM ({inputs.ORDER_POINTS_SQL}) WHERE {_MONTH} = 2
      OR {_MONTH} = 5 AND CATEGORY_OPTION_COMBO = 'cocLow'"""
)
def incremental_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run whose batches are rejected, fail or get no answer, and two that find no file but send again what is pending.

    March fails at first; what stays unanswered or rejected to the end is pending.
    """
    landing, pushed, out, state = (scratch_dir(spark, n) for n in ("landing", "pushed", "out", "state"))
    inputs.order_points(spark, sf_dir).write.parquet(landing)
    for turn in range(3):
        publish_incoming(
            spark, landing, POINT, lambda df: df, pushed, out, state, _replies, inputs.BATCH_SIZE, files_per_batch=None
        ).awaitTermination()
        if turn:
            retry_pending(spark, pushed, out, lambda epoch, paths: _replies(1, paths), inputs.BATCH_SIZE)
    posted = read_stage(spark, pushed, schema=POINT).select(F.lit("posted").alias("state"), "*")
    pending = read_pending(spark, out, last_epoch(spark, out)).select(F.lit("pending").alias("state"), "*")
    return posted.unionByName(pending)


@query(
    f"""SELECT DX_UID, count(*) AS count, min(VALUE) AS sample_alpha_value FROM ({inputs.POINTS_SQL})
    WHERE NOT regexp_matches(VALUE, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') GROUP BY DX_UID"""
)
def non_numeric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets with text values, from the transformed stage to a CSV report."""
    done, out = scratch_dir(spark, "transformed"), scratch_dir(spark, "report")
    write_stage(inputs.points(spark, sf_dir), done)
    report_non_numeric(spark, done, out)
    return read_csv(spark, out)


@query(
    f"""SELECT DISTINCT PERIOD, ORG_UNIT FROM (SELECT {inputs.ORDER_PERIOD} AS PERIOD, concat('C', o_custkey) AS ORG_UNIT, first_value(
        o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') OVER (PARTITION BY o_custkey, {inputs.ORDER_PERIOD} ORDER BY o_orderkey) AS ok
      FROM orders) WHERE ok"""
)
def completion_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole completion run, repeated; the log holds each pushed unit once."""
    log, out = scratch_dir(spark, "log"), scratch_dir(spark, "out")
    units = requested(spark, sf_dir)
    for run in range(2):
        plan = completion_plan.prepare_completion(
            spark, units, registrations(spark, sf_dir), "dsTarget", log, f"{out}/plan={run}"
        )
        replies = plan.where("payload IS NOT NULL").select(
            "PERIOD", "ORG_UNIT", F.lit(200).alias("status_code"),
            F.when(F.col("completed"), '{"status":"SUCCESS","importCount":{"imported":1}}').otherwise(
                '{"status":"WARNING","importCount":{"ignored":1}}'
            ).alias("body"),
        )
        completion_plan.settle_completion(spark, plan, replies, log, f"{out}/settled={run}")
    return read_processed(spark, log)
