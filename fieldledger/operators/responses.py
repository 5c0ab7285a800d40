"""Import responses: counts, errors, rejected points, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.schemas import IMPORT_COUNTS, RESPONSE_BODY


def parse_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add ``r``, the parsed body, and ``parse_failed`` for a body that is no JSON object.

    ``from_json`` gives a struct of nulls for bad text, so the text is tested on its own.
    """
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT"), F.lit(False))
    parsed = F.when(is_object, F.from_json(body, RESPONSE_BODY))
    return responses.withColumn("parse_failed", ~is_object).withColumn("r", parsed)


def counts_per_response(parsed: DataFrame) -> DataFrame:
    """Add the import counts of each response.

    Counts at the top win over nested ones as a whole; a missing number is 0.
    """
    counts = F.coalesce(F.col("r.importCount"), F.col("r.response.importCount"))
    return parsed.withColumns({name: F.coalesce(counts[name], F.lit(0)) for name in IMPORT_COUNTS})


def fold_counts(parsed: DataFrame) -> DataFrame:
    """One row: the sum of each import count, the responses, and those that could not be parsed."""
    return counts_per_response(parsed).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in IMPORT_COUNTS],
        F.count(F.lit(1)).alias("responses"),
        F.count_if("parse_failed").alias("parse_failures"),
    )


def import_errors(parsed: DataFrame) -> DataFrame:
    """One row per conflict or error report, at the top or nested, and per response without a body.

    ``kind`` says which, ``value`` and ``errorCode`` are filled where the server gives them, ``detail``
    is the whole entry as JSON.
    """
    kind = "array<struct<kind:string,value:string,errorCode:string,detail:string>>"

    def entries(path: str, name: str):
        return F.transform(
            F.coalesce(F.col(path), F.expr("array()")),
            lambda e: F.struct(
                F.lit(name).alias("kind"),
                e["value"].alias("value"),
                e["errorCode"].alias("errorCode"),
                F.to_json(e).alias("detail"),
            ),
        ).cast(kind)

    found = F.concat(
        entries("r.conflicts", "conflict"),
        entries("r.response.conflicts", "conflict"),
        entries("r.errorReports", "error_report"),
        entries("r.response.errorReports", "error_report"),
    )
    silent = F.array(
        F.struct(
            F.lit("request_error").alias("kind"),
            F.lit(None).cast("string").alias("value"),
            F.col("status_code").cast("string").alias("errorCode"),
            F.lit(None).cast("string").alias("detail"),
        )
    ).cast(kind)
    rows = F.when(F.col("parse_failed") & (F.col("status_code") >= 400), silent).otherwise(found)
    return parsed.select("batch_id", "status_code", F.inline(rows))


def _indexes() -> Column:
    """All rejected positions of a parsed response."""
    return F.concat(
        F.coalesce(F.col("r.rejectedIndexes"), F.expr("array()").cast("array<int>")),
        F.coalesce(F.col("r.response.rejectedIndexes"), F.expr("array()").cast("array<int>")),
    )


def rejected_positions(parsed: DataFrame) -> DataFrame:
    """Distinct rejected positions per batch."""
    return parsed.select("batch_id", F.explode(F.array_distinct(_indexes())).alias("batch_pos")).distinct()


def rejected_points(batched: DataFrame, parsed: DataFrame) -> DataFrame:
    """The points at rejected positions of their batch; a position out of range finds none."""
    return batched.join(rejected_positions(parsed), ["batch_id", "batch_pos"], "left_semi")


def batch_verdicts(parsed: DataFrame) -> DataFrame:
    """One row per answered batch: whether it is ``ok``, and its ``rejected`` positions.

    A batch is fine if its answers could be read, are no HTTP error and do not say ERROR.
    """
    fine = ~F.col("parse_failed") & (F.coalesce(F.col("status_code"), F.lit(200)) < 400)
    status = F.coalesce(F.col("r.status"), F.lit(""))
    return parsed.where(F.col("batch_id").isNotNull()).groupBy("batch_id").agg(
        F.bool_and(fine & (status != "ERROR")).alias("ok"),
        F.array_distinct(F.flatten(F.collect_list(_indexes()))).alias("rejected"),
    )


def held_points(batched: DataFrame, parsed: DataFrame) -> DataFrame:
    """The points nobody accepted: those of batches without a good answer, and those at rejected positions.

    Points are joined once, with one row per batch, and come out once each, as a batch has one point at a position.
    """
    verdicts = batch_verdicts(parsed).select(F.col("batch_id").alias("_batch"), "ok", "rejected")
    judged = batched.join(verdicts, batched["batch_id"] == verdicts["_batch"], "left")
    accepted = F.coalesce(F.col("ok") & ~F.coalesce(F.array_contains("rejected", F.col("batch_pos")), F.lit(False)), F.lit(False))
    return judged.where(~accepted).select(*[batched[c] for c in batched.columns])


def server_errors(parsed: DataFrame) -> DataFrame:
    """Responses with a server error and its message: any of them must stop a publish."""
    message = F.coalesce(
        F.col("r.message"),
        F.concat(F.lit("HTTP "), F.col("status_code").cast("string"), F.lit(" without a message")),
    )
    failed = parsed.where((F.col("status_code") >= 500) & (F.col("status_code") < 600))
    return failed.select(
        "batch_id", "status_code", F.concat(F.lit("Import stopped by the server: "), message).alias("message")
    )


def check_server_errors(parsed: DataFrame) -> None:
    """Raise if any response is a server error; reads one row."""
    first = server_errors(parsed).orderBy("batch_id").first()
    if first is not None:
        raise RuntimeError(f"{first.message} (batch {first.batch_id})")


def completion_status(parsed: DataFrame) -> DataFrame:
    """Outcome of completion responses.

    ``failed`` with one push error per conflict for a status of ERROR or WARNING or any conflict;
    ``parse_failed`` with one push error for a missing or empty body; ``failed`` for any other HTTP
    error; else ``pushed``. Counts come from the top level, and only from conflicting or successful
    responses.
    """
    conflicts = F.coalesce(F.size("r.conflicts"), F.lit(0))
    n_conflicts = F.when(conflicts > 0, conflicts).otherwise(0)
    status = F.coalesce(F.col("r.status"), F.lit(""))
    empty = F.col("parse_failed") | F.coalesce(F.regexp_like("body", F.lit(r"^\s*\{\s*\}\s*$")), F.lit(True))
    conflicting = ~empty & (status.isin("ERROR", "WARNING") | (n_conflicts > 0))
    http_error = F.coalesce(F.col("status_code") >= 400, F.lit(False))
    outcome = (
        F.when(empty, "parse_failed").when(conflicting | http_error, "failed").otherwise("pushed")
    )
    counted = conflicting | (~empty & (status == "SUCCESS"))
    counts = {
        name: F.when(counted, F.coalesce(F.col(f"r.importCount.{name}"), F.lit(0))).otherwise(0)
        for name in IMPORT_COUNTS
    }
    return parsed.withColumns(
        {
            "outcome": outcome,
            "push_errors": F.when(empty, 1).when(conflicting, n_conflicts).otherwise(0),
            **counts,
        }
    )
