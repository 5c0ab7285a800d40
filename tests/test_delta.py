"""Delta, snapshot and reconciliation on points with repeated and null keys."""

import itertools
import random
import re
from datetime import date

import pytest
from pyspark.sql import Observation, functions as F

from fieldledger.catalog import inputs
from fieldledger.operators import delta as cdc, reconcile
from fieldledger.operators.packs import Packs
from fieldledger.plans.transform import canonical_points, packed_points
from fieldledger.schemas import MAPPING, POINT, POINT_KEYS
from fieldledger.settings import Derivations, PointRules
from fieldledger.streaming.incoming import upsert_snapshot


def points(spark, rows):
    """Points of (period, unit, dx, value)."""
    full = [(p, u, d, "c", "a", v, "DATA_ELEMENT") for p, u, d, v in rows]
    return spark.createDataFrame(full, POINT)


def short(df):
    return sorted(((r.PERIOD, r.ORG_UNIT, r.DX_UID, r.VALUE, r.change_type) for r in df.collect()), key=str)


CURRENT = [
    (202401, "ou1", "dx1", "5"),
    (202401, "ou1", "dx2", "7"),
    (202401, "ou2", "dx1", "1"),
    (202401, "ou4", "dx1", None),
    (202401, None, "dx1", "4"),
    (202401, "ou5", "dx1", "2"),
    (202401, "ou5", "dx1", "3"),
    (202401, "ou6", "dx1", "8"),
]
POSTED = [
    (202401, "ou1", "dx1", "5"),
    (202401, "ou1", "dx2", "6"),
    (202401, "ou4", "dx1", "9"),
    (202401, None, "dx1", "4"),
    (202401, "ou5", "dx1", "2"),
    (202401, "ou5", "dx1", "2"),
    (202401, "ou5", "dx1", "4"),
    (202401, "ou6", "dx1", None),
    (202401, "gone", "dx1", "1"),
]
EXPECTED = sorted(
    [
        (202401, "ou1", "dx2", "7", "changed"),
        (202401, "ou2", "dx1", "1", "new"),
        (202401, None, "dx1", "4", "new"),
        (202401, "ou5", "dx1", "2", "changed"),
        (202401, "ou5", "dx1", "3", "changed"),
    ],
    key=str,
)


@pytest.mark.parametrize("unique", [False, True])
def test_delta(spark, unique):
    """Values that differ within a posted key make all its current rows changed, each once."""
    own = [r for r in POSTED if not unique or r[1] != "ou5"]
    found = cdc.delta(points(spark, CURRENT), points(spark, own), posted_unique=unique)
    assert short(found) == sorted([(*r[:4], "new") if unique and r[1] == "ou5" else r for r in EXPECTED], key=str)
    assert short(cdc.delta(points(spark, CURRENT), None))[0][4] == "new"


def brute(current, posted):
    out = []
    for row in current:
        same = [p for p in posted if None not in row[:3] and p[:3] == row[:3]]
        if not same:
            out.append((*row, "new"))
        if any(None not in (p[3], row[3]) and p[3] != row[3] for p in same):
            out.append((*row, "changed"))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_delta_against_brute_force(spark, seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([1, 2, None]), rng.choice(["a", "b", None]), "d", rng.choice(["x", "y", None]))
    current, posted = [row() for _ in range(60)], [row() for _ in range(60)]
    assert short(cdc.delta(points(spark, current), points(spark, posted))) == brute(current, posted)


def test_hot_key_makes_no_pairs(spark):
    one = points(spark, [(202401, "ou", "dx", "1")])
    same = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(30_000))).alias("n")).drop("n")
    plan_rows = cdc.delta(same, same)
    assert plan_rows.count() == 0  # 9e8 pairs if copies of one posted row were not counted first


def test_repeated_equal_rows_are_unchanged(spark):
    same = points(spark, [(202401, "ou", "dx", "1")] * 300)
    assert cdc.delta(same, same).count() == 0
    other = points(spark, [(202401, "ou", "dx", "2")] * 300)
    assert cdc.delta(same, other).count() == 300


def test_second_publish_is_empty_and_delta_leads_to_current(spark):
    unique = [r for r in CURRENT if None not in r and r[1] != "ou5"]
    current, posted = points(spark, unique), points(spark, [r for r in POSTED if None not in r and r[1] != "ou5"])
    assert cdc.delta(current, cdc.next_snapshot(current, posted, None)).count() == 0
    changes = cdc.delta(current, posted).drop("change_type")
    applied = upsert_snapshot(changes, posted).join(current.select(POINT_KEYS), POINT_KEYS, "left_semi")
    assert sorted(map(tuple, applied.select(current.columns).collect())) == sorted(map(tuple, current.collect()))


def test_deletes(spark):
    found = cdc.delta_with_deletes(points(spark, CURRENT), points(spark, POSTED))
    removed = [r for r in short(found) if r[4] == "removed"]
    # A posted row with a null key matches nothing, so it too counts as gone.
    assert removed == sorted([(202401, "gone", "dx1", None, "removed"), (202401, None, "dx1", None, "removed")], key=str)


def test_snapshot_keeps_rejected(spark):
    current, posted = points(spark, CURRENT[:3]), points(spark, POSTED[:2])
    rejected = points(spark, [CURRENT[1], CURRENT[2]])
    kept = cdc.next_snapshot(current, posted, rejected).collect()
    assert sorted((r.ORG_UNIT, r.DX_UID, r.VALUE) for r in kept) == [("ou1", "dx1", "5"), ("ou1", "dx2", "6")]


def test_observed_counts(spark, tmp_path):
    current, posted = points(spark, CURRENT), points(spark, POSTED)
    seen = Observation("delta")
    cdc.delta(current, posted, seen=seen).write.parquet(str(tmp_path / "out"))
    assert seen.get == {"all": len(CURRENT), "new": 2, "changed": 3}
    counts = {r.metric: r.n for r in cdc.delta_counts(current, posted).collect()}
    assert counts == seen.get
    assert {r.metric: r.n for r in cdc.delta_counts(current.limit(0), posted).collect()} == {"all": 0}


def test_delta_sorts_nothing_but_longs(spark):
    plan = cdc.delta(points(spark, CURRENT), points(spark, POSTED), join_hint="merge")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_keys_of_other_types(spark):
    current = points(spark, CURRENT)
    wide = points(spark, POSTED).withColumn("PERIOD", F.col("PERIOD").cast("long"))
    assert cdc.delta(current, wide).exceptAll(cdc.delta(current, points(spark, POSTED))).count() == 0


def test_duplicate_report(spark):
    row = cdc.duplicate_keys(points(spark, CURRENT)).first()
    assert (row.ORG_UNIT, row.n_rows, row.min_value, row.max_value) == ("ou5", 2, "2", "3")


def test_delta_plan(spark, tmp_path):
    """One shuffle of each side for the join; the posted side is reduced before its shuffle."""
    for name, rows in (("c", CURRENT), ("p", POSTED)):
        points(spark, rows).write.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = cdc.delta(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p")))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("partial_min") == 2
    assert plan.count("SortMergeJoin") == 1


def test_mismatch_and_gate(spark):
    audit = spark.createDataFrame(
        [(202401, "ou1", 1, 1, 2), (202401, "ou5", 2, 2, None), (202402, "ou1", 1, 1, 0), (202402, "ou2", 1, 1, 3)],
        "period int, organization_unit string, extracted_count long, transformed_count long, pushed_count long",
    )
    found = reconcile.mismatched_units(points(spark, CURRENT), audit).collect()
    assert sorted((str(r.ORG_UNIT), r.record_count, r.pushed_count) for r in found) == [
        ("None", 1, 0), ("ou2", 1, 0), ("ou4", 1, 0), ("ou5", 2, 0), ("ou6", 1, 0),
    ]
    wanted = spark.createDataFrame([(202401,), (202402,), (202403,)], "PERIOD int")
    gate = reconcile.stage_gate(wanted, audit.where("period <> 202401 OR pushed_count IS NULL"), "pushed")
    assert sorted(tuple(r) for r in gate.collect()) == [(202401, 0, True), (202402, 3, False), (202403, 0, True)]
    with pytest.raises(ValueError, match="stage"):
        reconcile.stage_gate(wanted, audit, "other")


def test_audit(spark):
    table = reconcile.audit_counts({"extracted": points(spark, CURRENT[:3]), "pushed": points(spark, CURRENT[:1])})
    got = {r.organization_unit: (r.extracted_count, r.transformed_count, r.pushed_count) for r in table.collect()}
    assert got == {"ou1": (2, 0, 1), "ou2": (1, 0, 0)}
    assert len(list(itertools.chain(table.columns))) == 5
    assert table.select(F.sum("pushed_count")).first()[0] == 1


def packs(spark, rows, targets):
    """Packs of (period, unit, {position: value})."""
    full = [(p, u, list(v), list(v.values())) for p, u, v in rows]
    frame = spark.createDataFrame(full, "PERIOD int, ORG_UNIT string, at array<int>, value array<string>")
    return Packs(frame, lambda df: df, [(dx, "c", "a", "DATA_ELEMENT") for dx in targets])


# dx1 stands at two positions; the posted side has its targets in another order.
PACKS = [
    (202401, "ou1", {0: "5", 1: "7"}),
    (202401, "ou2", {0: "1", 2: "1"}),
    (202401, "ou3", {0: "1"}),
    (202401, "ou3", {0: "1", 1: "2"}),
    (202401, "ou4", {0: "3", 1: "3"}),
    (202401, "ou5", {}),
    (202402, "ou1", {0: "5"}),
    (202401, "ou6", {0: "1", 1: "4"}),
    (202401, None, {0: "1"}),
]
POSTED_PACKS = [
    (202401, "ou1", {1: "5", 0: "6"}),
    (202401, "ou2", {1: "1"}),
    (202401, "ou3", {1: "1", 0: "3"}),
    (202401, "ou4", {1: "3"}),
    (202401, "ou4", {1: "4", 0: "3"}),
    (202401, "ou6", {}),
    (202401, None, {1: "1"}),
    (202401, None, {1: "1"}),
    (202401, "gone", {1: "1"}),
]


@pytest.mark.parametrize("targets", [["dx1", "dx2", "dx1"], ["dx1", "dx2", "dx3"]])
@pytest.mark.parametrize("old", [["dx2", "dx1"], ["dx1", "dx1"]])
@pytest.mark.parametrize("posted", [POSTED_PACKS, [r for r in POSTED_PACKS if r[1] not in ("ou4", None)]])
def test_packs_give_the_rows_of_their_points(spark, targets, old, posted):
    now, before = packs(spark, PACKS, targets), packs(spark, posted, old)
    want = short(cdc.delta(now.points(), before.points()))
    assert want and short(cdc.delta(now, before)) == want
    counted = sorted(map(tuple, cdc.delta_counts(now, before, join_hint="merge").collect()))
    assert counted == sorted(map(tuple, cdc.delta_counts(now.points(), before.points()).collect()))
    for side in (now, before, packs(spark, posted[:3], ["dx2", "dx1"])):
        repeats = sorted(map(tuple, cdc.duplicate_keys(side.points()).collect()), key=str)
        assert sorted(map(tuple, cdc.duplicate_keys(side).collect()), key=str) == repeats


def exchanged(df):
    """Columns of each shuffle of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_packs_are_shuffled_by_unit(spark):
    """One row per submission moves, not one per point: no shuffle is by target."""
    now, before = packs(spark, PACKS, ["dx1", "dx2", "dx3"]), packs(spark, [POSTED_PACKS[0]], ["dx2", "dx1"])
    shuffles = exchanged(cdc.delta(now, before, join_hint="merge"))
    assert shuffles and all("PERIOD" in line and "DX_UID" not in line and "_own" not in line for line in shuffles)
    once = packs(spark, PACKS[:3], ["dx1", "dx2", "dx3"])
    assert not any("Exchange" in line and "ORG_UNIT" not in line for line in exchanged(cdc.duplicate_keys(once)))


NUMBERS = [0.0, -0.0, 1.0, 5.0, 12345678.0, 1e-5, 1e20, 0.1 + 0.2, float("inf"), float("-inf"), float("nan"), None]
TEXTS = ["0.0", "-0.0", "1.00", "5", "12345678", "1e-5", "100000000000000000000.0", "Infinity", "-Infinity", "nan", " ", None, "x"]


def wide(spark, numbers, texts, kinds):
    """One submission per pair of values; those of the second half of the numbers come twice."""
    rows = [(202401, f"ou{i}-{j}", n, t) for i, n in enumerate(numbers) for j, t in enumerate(texts)]
    rows += rows[len(rows) // 2 :]
    number, text = kinds
    frame = spark.createDataFrame(rows, "periode int, reference_externe string, n double, t string")
    return frame.select(F.lit(1).alias("export_id"), "periode", "reference_externe", F.col("n").cast(number), F.expr(f"try_cast(t AS {text})").alias("t"))


@pytest.mark.parametrize(
    ("uids", "kinds", "twice"),
    [
        (("dx1", "dx2"), ("double", "string"), False),
        (("dx1", "dx2"), ("string", "double"), True),
        (("dx1", "dx1"), ("string", "string"), False),
        (("dx1", "dx1"), ("float", "string"), True),
    ],
)
def test_packs_compare_values_as_their_texts(spark, uids, kinds, twice):
    """Numbers are compared before they have a format, also where a column was texts on one side; the rows are the same."""
    mapping = spark.createDataFrame([(name, uid, "", None, None) for name, uid in zip("nt", uids, strict=True)], MAPPING)
    now = wide(spark, NUMBERS, TEXTS, ("double", "string"))
    before = wide(spark, NUMBERS[1:] + NUMBERS[:1], TEXTS[2:] + TEXTS[:2], kinds)
    before = before if twice else before.dropDuplicates(["reference_externe"])
    given = mapping, Derivations(), PointRules(unmapped_prefixes=()), date(2024, 12, 31)
    packed = [packed_points(df, *given) for df in (now, before)]
    want = short(cdc.delta(*[sides.points() for sides in packed]))
    assert len({kind for *_, kind in want}) == 2 and short(cdc.delta(*packed)) == want
    counted = sorted(map(tuple, cdc.delta_counts(*packed).collect()))
    assert counted == sorted(map(tuple, cdc.delta_counts(*[sides.points() for sides in packed]).collect()))


def test_packs_of_a_form_hold_the_canonical_points(spark):
    mapping = spark.createDataFrame([("n", "dx1", "", None, None), ("t", "dx2", "c", None, None)], MAPPING)
    given = wide(spark, NUMBERS, TEXTS, ("double", "string")), mapping, Derivations(), PointRules(unmapped_prefixes=()), date(2024, 12, 31)
    want = sorted(map(tuple, canonical_points(*given).collect()))
    assert want and sorted(map(tuple, packed_points(*given).points().collect())) == want


@pytest.fixture
def lines(spark, tmp_path):
    """Lines of orders, some of them twice."""
    rows = [(k, k % 9, k % 5 + 1, float(k % 51), 10.5 * k, k % 11 / 100, k % 9 / 100, "NAR"[k % 3], "OF"[k % 2]) for k in range(120)]
    names = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    frame = spark.createDataFrame(rows + rows[:20], f"{names}, l_tax double, l_returnflag string, l_linestatus string")
    frame.withColumn("l_shipdate", F.expr("timestamp_ntz '1999-03-04 00:00:00'")).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def compiled(df):
    """Plan without adaptive parts, and the greatest number of bytes of a generated method."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return plan.toString(), max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))


def test_delta_of_packs_is_compiled(spark, lines):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter; higher-order functions are no generated code."""
    now, before = inputs.packs(spark, lines), inputs.earlier_packs(spark, lines)
    plan, size = compiled(cdc.delta(now, before, join_hint="merge"))
    assert size < 8000 and "lambda" not in plan
    source, size = compiled(now.source)
    assert size < 8000 and source.count("concat(U") == 1


def test_counts_of_packs_format_nothing(spark, lines):
    """Numbers are counted as new or changed by themselves, in compiled code."""
    now, before = inputs.packs(spark, lines), inputs.earlier_packs(spark, lines)
    plan, size = compiled(cdc.delta_counts(now, before, posted_unique=True, join_hint="merge"))
    assert size < 8000 and "format_string" not in plan and "lambda" not in plan


def test_lines_give_the_delta_of_their_points(spark, lines):
    now, before = inputs.packs(spark, lines), inputs.earlier_packs(spark, lines)
    want = short(cdc.delta(inputs.points(spark, lines), inputs.earlier_points(spark, lines)))
    assert {kind for *_, kind in want} == {"new", "changed"} and short(cdc.delta(now, before, join_hint="merge")) == want
