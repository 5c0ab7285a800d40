"""Payload rows, batches and responses."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldledger.operators import batches, points as ops, responses

SCHEMA = (
    "dataElement string, period int, orgUnit string, categoryOptionCombo string, "
    "attributeOptionCombo string, value string"
)
ROWS = [
    ("pCbiHFTLwRX", 202308, "HdzPBv3jpme", "HllvX50cXC0", "HllvX50cXC0", "1"),
    ("pCbiHFTLwRX", 202308, "cqgQ8nLcRoM", "HllvX50cXC0", "HllvX50cXC0", None),
    ("pCbiHFTLwRX", 202308, "cqgQ8nLcRoM", "HllvX50cXC0", "HllvX50cXC0", " "),
    ("pCbiHFTLwRX", 202308, None, "HllvX50cXC0", "HllvX50cXC0", "1"),
    ("pCbiHFTLwRX", 202308, None, "HllvX50cXC0", "HllvX50cXC0", None),
]


def test_classes_and_json(spark):
    df = ops.point_json(ops.classify_points(spark.createDataFrame(ROWS, SCHEMA)))
    got = df.collect()
    assert [r.point_class for r in got] == ["valid", "delete", "valid", "ignored", "ignored"]
    assert json.loads(got[0].point) == {
        "dataElement": "pCbiHFTLwRX", "period": 202308, "orgUnit": "HdzPBv3jpme",
        "categoryOptionCombo": "HllvX50cXC0", "attributeOptionCombo": "HllvX50cXC0", "value": "1",
    }
    for row in got[1:3]:
        assert json.loads(row.point)["comment"] == "deleted value" and json.loads(row.point)["value"] == ""


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([("d", 1, "o", "c", "a", float("nan"))], SCHEMA.replace("value string", "value double"))
    assert ops.classify_points(df).first().point_class == "delete"


def test_dx_alias_and_missing_fields(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert ops.classify_points(df.withColumnRenamed("dataElement", "dx")).columns[0] == "dataElement"
    with pytest.raises(ValueError, match="orgUnit"):
        ops.classify_points(df.drop("orgUnit"))
    with pytest.raises(ValueError, match="DX_UID"):
        ops.payload_rows(df)


def many(spark, n=5000):
    """A third of the rows are copies of one row, and one period holds nearly all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), "id")).alias("dataElement"),
        F.when(F.col("id") % 50 == 1, 202402).otherwise(202401).alias("period"),
        F.when(F.col("id") % 3 == 0, "ou").otherwise(F.concat(F.lit("o"), F.col("id") % 7)).alias("orgUnit"),
        F.lit("c").alias("categoryOptionCombo"),
        F.lit("a").alias("attributeOptionCombo"),
        F.when(F.col("id") % 3 != 1, "5").alias("value"),
    )


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


# One bucket; many buckets; many buckets with copies of one row in one of them.
@pytest.mark.parametrize("bucket_rows", [10_000, 1_000, 100])
def test_batches_are_full_and_positions_unique(spark, bucket_rows):
    source = many(spark)
    batched = batches.batch_points(source, size=64, bucket_rows=bucket_rows).collect()
    names = source.columns
    assert Counter(tuple(r[n] for n in names) for r in batched) == Counter(tuple(r) for r in source.collect())
    groups = Counter((r.period, r.point_class) for r in batched)
    by_batch = Counter((r.period, r.point_class, r.batch_no) for r in batched)
    for (period, kind), n in groups.items():
        sizes = [by_batch[(period, kind, i)] for i in range(-(-n // 64))]
        assert sum(sizes) == n and all(s == 64 for s in sizes[:-1]) and 0 < sizes[-1] <= 64
    assert len({(r.batch_id, r.batch_pos) for r in batched}) == len(batched)
    assert all(0 <= r.batch_pos < 64 for r in batched)


def test_batches_are_the_same_for_any_partitioning(spark):
    one = batches.batch_points(many(spark).coalesce(1), 64)
    for other in (batches.batch_points(many(spark).repartition(13), 64, n) for n in (10_000, 900, 100)):
        assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_rows_are_shuffled_once_for_batches(spark):
    """Also with many buckets; copies of one row are counted first, and dealt by batch at the end."""
    distinct = spark.range(6000).select(F.col("id").cast("string").alias("dataElement"), (F.col("id") % 2).alias("period"))
    assert exchanges(batches.number_batches(distinct, 64, ["period"])) == 1
    assert exchanges(batches.number_batches(distinct, 64, ["period"], 500)) <= 2
    assert exchanges(batches.number_batches(many(spark), 64, ["period"], 100)) <= 4


def test_buckets_follow_the_digest(spark):
    rows = spark.range(3000).select(batches.content_digest(["id"]).alias("d"))
    for bits in (1, 5, 31, 32):
        assert all(int(r.d[:8], 16) >> (32 - bits) == r.b for r in rows.select("d", batches._bucket(F.col("d"), bits).alias("b")).collect())
    assert [batches._bits(n, 100) for n in (0, 100, 101, 200, 201, 400, 10**15)] == [0, 0, 1, 1, 2, 2, 32]


def test_digests_tell_null_from_text(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(batches.content_digest(["x", "y"])).distinct().count() == len(rows)


def test_payloads(spark):
    got = batches.batch_payloads(batches.batch_points(many(spark, 300), 50), "UPDATE", False).collect()
    for row in got:
        values = json.loads(row.payload)["dataValues"]
        assert len(values) == row.n_points <= 50
        assert all(("comment" in v) == (row.point_class == "delete") for v in values)
        assert (row.importStrategy, row.dryRun, row.preheatCache, row.skipAudit) == ("UPDATE", False, True, True)
    with pytest.raises(ValueError, match="import strategy"):
        batches.batch_payloads(many(spark), "DELETE")


def test_bad_batch_arguments(spark):
    with pytest.raises(ValueError):
        batches.number_batches(many(spark), 0)
    with pytest.raises(ValueError):
        batches.number_batches(many(spark), 5, bucket_rows=0)


BODIES = [
    ("top", 200, '{"importCount":{"imported":3,"updated":1}}'),
    ("nested", 200, '{"response":{"importCount":{"imported":2,"deleted":1},"rejectedIndexes":[1,99]}}'),
    ("both", 200, '{"importCount":{"imported":1},"response":{"importCount":{"imported":50,"updated":50}}}'),
    ("neither", 200, '{"status":"OK"}'),
    ("text", 502, "<html>bad gateway</html>"),
    ("conflict", 409, '{"status":"ERROR","conflicts":[{"object":"o","objects":{"a":"b"},"value":"v","errorCode":"E"}],"rejectedIndexes":[0]}'),
    ("server", 500, '{"message":"boom"}'),
    ("silent", 503, None),
]


def parsed(spark, only=None):
    rows = [r for r in BODIES if only is None or r[0] in only]
    return responses.parse_responses(spark.createDataFrame(rows, "batch_id string, status_code int, body string"))


def test_response_fold(spark):
    row = responses.fold_counts(parsed(spark)).first()
    assert (row.imported, row.updated, row.ignored, row.deleted) == (6, 1, 0, 1)
    assert (row.responses, row.parse_failures) == (8, 2)
    assert responses.fold_counts(parsed(spark).where("false")).first().imported == 0


def test_response_errors(spark):
    got = {(r.batch_id, r.kind, r.value, r.errorCode) for r in responses.import_errors(parsed(spark)).collect()}
    assert got == {
        ("conflict", "conflict", "v", "E"), ("text", "request_error", None, "502"), ("silent", "request_error", None, "503"),
    }


def test_server_errors(spark):
    got = {r.batch_id: r.message for r in responses.server_errors(parsed(spark)).collect()}
    assert got == {
        "server": "Import stopped by the server: boom",
        "text": "Import stopped by the server: HTTP 502 without a message",
        "silent": "Import stopped by the server: HTTP 503 without a message",
    }
    with pytest.raises(RuntimeError, match="Import stopped by the server: boom"):
        responses.check_server_errors(parsed(spark, {"server", "top"}))
    responses.check_server_errors(parsed(spark, {"top", "conflict"}))


def test_rejected(spark):
    batched = spark.createDataFrame([("nested", 0, "a"), ("nested", 1, "b"), ("conflict", 0, "c")], "batch_id string, batch_pos int, dx string")
    got = sorted(r.dx for r in responses.rejected_points(batched, parsed(spark)).collect())
    assert got == ["b", "c"]


def test_completion_status(spark):
    got = {r.batch_id: (r.outcome, r.push_errors, r.imported) for r in responses.completion_status(parsed(spark)).collect()}
    assert got["conflict"] == ("failed", 1, 0)
    assert got["text"] == ("parse_failed", 1, 0) and got["silent"] == ("parse_failed", 1, 0)
    assert got["server"][0] == "failed" and got["neither"] == ("pushed", 0, 0) and got["top"] == ("pushed", 0, 0)


def test_points_without_a_good_answer_are_held(spark):
    names = ("top", "neither", "nested", "conflict", "text", "none")
    batched = spark.createDataFrame([(n, k, f"{n}{k}") for n in names for k in (0, 1)], "batch_id string, batch_pos int, dx string")
    got = sorted(r.dx for r in responses.held_points(batched, parsed(spark)).collect())
    assert got == ["conflict0", "conflict1", "nested1", "none0", "none1", "text0", "text1"]


def test_held_points_take_one_join(spark):
    """Many points with few answers: one join per point, and a point held for two reasons comes out once."""
    batched = spark.range(1000).selectExpr("concat('b', id div 10) AS batch_id", "CAST(id % 10 AS INT) AS batch_pos", "concat('d', id) AS dx")
    rows = [(f"b{n}", 409 if n % 2 else 200, json.dumps({"rejectedIndexes": [0, 3, 40], "response": {"rejectedIndexes": [3]}})) for n in range(90)]
    rows += [("b2", 200, json.dumps({"rejectedIndexes": [5, None]})), ("b4", 500, "{}"), (None, 200, "{}")]
    answers = responses.parse_responses(spark.createDataFrame(rows, "batch_id string, status_code int, body string"))
    held = responses.held_points(batched, answers)
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    good = [n for n in range(0, 90, 2) if n != 4]
    accepted = {f"d{n * 10 + k}" for n in good for k in range(10) if k not in (0, 3) and (n, k) != (2, 5)}
    got = [r.dx for r in held.collect()]
    assert len(got) == len(set(got)) and set(got) == {f"d{i}" for i in range(1000)} - accepted
    rejected = sorted(r.dx for r in responses.rejected_points(held, answers).collect())
    assert rejected == sorted(r.dx for r in responses.rejected_points(batched, answers).collect())
