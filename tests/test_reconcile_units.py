"""Hierarchy alignment and completion on edge rows."""

import json

import pytest
from pyspark.sql import functions as F

from fieldledger.operators import completion, hierarchy
from fieldledger.schemas import ORG_UNIT, PROCESSED, REGISTRATION

POINT = '{"type":"Point","coordinates":[1.0,2]}'


def unit(id, name="n", short="s", opening="2020-01-01", closed=None, parent="p", level=2, geometry=POINT, seq=1):
    return (id, name, short, opening, closed, (parent,) if parent else None, level, f"/{id}", geometry, seq)


def units(spark, *rows):
    return spark.createDataFrame(list(rows), ORG_UNIT)


def both(spark):
    source = units(
        spark,
        unit("new"), unit("new", seq=2), unit("invalid", short=None), unit("root", parent=None),
        unit("same", geometry='{"coordinates":[1,2.0],"type":"Point"}'),
        unit("renamed", name="b"), unit("levelled", level=3), unit("bad", geometry="{"), unit("closed", closed="2021-01-01"),
        unit("twice", name="old", seq=1), unit("twice", name="n", seq=2), unit("moved", parent="q"),
    )
    target = units(
        spark,
        unit("same"), unit("renamed"), unit("levelled"), unit("bad", geometry=None), unit("closed"),
        unit("twice", name="n", seq=9), unit("twice", name="other", seq=3), unit("moved"), unit("only target"),
    )
    return source, target


def test_actions(spark):
    got = hierarchy.alignment_actions(*both(spark), "2.36").collect()
    kinds = sorted((r.action, r.ou_id, r.status) for r in got)
    assert kinds == [
        ("CREATE", "invalid", "NOTVALID"), ("CREATE", "new", "READY"), ("CREATE", "new", "READY"),
        ("CREATE", "root", "NOTVALID"), ("UPDATE", "closed", "READY"), ("UPDATE", "moved", "READY"),
        ("UPDATE", "renamed", "READY"),
    ]
    by_id = {r.ou_id: r.payload for r in got}
    assert by_id["invalid"] is None
    assert json.loads(by_id["new"]) == {
        "id": "new", "name": "n", "shortName": "s", "openingDate": "2020-01-01", "parent": {"id": "p"},
        "geometry": {"type": "Point", "coordinates": [1, 2]},
    }
    assert json.loads(by_id["closed"])["organisationUnits"][0]["closedDate"] == "2021-01-01"


def test_root_is_valid_without_the_parent_rule(spark):
    got = hierarchy.alignment_actions(*both(spark), require_parent=False)
    assert got.where("ou_id = 'root'").first().status == "READY"


def test_old_version_drops_geometry(spark):
    source, target = units(spark, unit("a"), unit("b")), units(spark, unit("a", geometry=None))
    got = hierarchy.alignment_actions(source, target, "2.9").collect()
    assert [(r.action, "geometry" in r.payload) for r in got] == [("CREATE", False)]
    assert hierarchy.takes_geometry("2.32.1") and not hierarchy.takes_geometry("2.32") and hierarchy.takes_geometry("2.40-SNAPSHOT")


def test_aligned_again_nothing_to_do(spark):
    source, _ = both(spark)
    assert hierarchy.alignment_actions(source, source).count() == 0


def test_report(spark):
    actions = hierarchy.alignment_actions(*both(spark))
    answers = spark.createDataFrame(
        [("UPDATE", "renamed", 200, '{"status":"OK","response":{"b":1,"a":2}}'), ("UPDATE", "moved", 409, "no json")],
        "action string, ou_id string, status_code int, body string",
    )
    got = {(r.action, r.ou_id): (r.statusCode, r.status, r.response) for r in hierarchy.alignment_report(actions, answers).collect()}
    assert got[("UPDATE", "renamed")] == (200, "OK", '{"a":2,"b":1}')
    assert got[("UPDATE", "moved")] == (409, None, None)
    assert got[("CREATE", "invalid")] == (None, "NOTVALID", None)
    unsent = hierarchy.alignment_report(actions)
    assert {r.status for r in unsent.collect()} == {"READY", "NOTVALID"}
    totals = {(r.action, r.status): r.n_units for r in hierarchy.alignment_totals(unsent).collect()}
    assert totals[("CREATE", "NOTVALID")] == 2


def registrations(spark, *rows):
    df = spark.createDataFrame([r[:5] for r in rows], REGISTRATION)
    seqs = spark.createDataFrame([(r[0], r[3], r[5]) for r in rows], "organisationUnit string, date string, seq long")
    return df.join(seqs, (df.organisationUnit == seqs.organisationUnit) & df.date.eqNullSafe(seqs.date)).select(df["*"], "seq")


def test_completion(spark):
    regs = registrations(
        spark,
        ("a", "202401", True, "2024-02-01", "s", 1), ("a", "202401", False, "2024-01-01", "s", 2),
        ("b", "202401", True, None, "s", 1), ("c", "202401", None, "2024-02-02", "s", 1),
        ("z", "202401", True, "2024-02-03", "s", 1), ("e", "202402", True, "2024-02-04", "s", 1),
    )
    requested = spark.createDataFrame([(202401, u) for u in "abcdef"], PROCESSED)
    log = spark.createDataFrame([(202401, "f"), (202401, None), (202402, "a")], PROCESSED)
    plan = completion.completion_plan(requested, log, regs, "target")
    got = {r.ORG_UNIT: (r.outcome, r.payload and json.loads(r.payload)["completeDataSetRegistrations"][0]) for r in plan.collect()}
    assert {u: o for u, (o, _) in got.items()} == {
        "a": "ready", "b": "missing_keys", "c": "missing_keys", "d": "no_completion", "e": "no_completion",
    }
    assert got["a"][1] == {"organisationUnit": "a", "period": "202401", "completed": True, "date": "2024-02-01", "dataSet": "target"}

    statuses = spark.createDataFrame([(202401, "a", "pushed", 0)], "PERIOD int, ORG_UNIT string, outcome string, push_errors int")
    outcomes = completion.completion_outcomes(plan, statuses)
    tallies = {r.outcome: (r.n_units, r.push_errors) for r in completion.outcome_tallies(outcomes).collect()}
    assert tallies == {"pushed": (1, 0), "missing_keys": (2, 2), "no_completion": (2, 0)}
    unanswered = completion.completion_outcomes(plan, statuses.where("false"))
    assert unanswered.where("ORG_UNIT = 'a'").first().outcome == "parse_failed"
    assert completion.newly_processed(outcomes).count() == 1
    assert completion.newly_processed(outcomes, mark_uncompleted=True).count() == 3
    merged = completion.merge_processed(log, completion.newly_processed(outcomes))
    assert merged.count() == 4 and completion.merge_processed(merged, merged).count() == 4
    assert completion.unprocessed_units(requested, merged).where("ORG_UNIT = 'a'").count() == 0


@pytest.mark.parametrize("plan_only", [True, False])
def test_outcomes_of_an_unsent_plan(spark, plan_only):
    plan = spark.createDataFrame([(1, "a", "missing_keys"), (1, "b", "ready")], "PERIOD int, ORG_UNIT string, outcome string")
    got = completion.completion_outcomes(plan, None).where(F.col("outcome") == ("ready" if plan_only else "missing_keys"))
    assert got.first().push_errors == (0 if plan_only else 1)
