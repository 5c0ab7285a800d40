"""Wide rows to points: derived columns, reshaping, mapping and filters."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldledger.operators import canonical, choices, columns, derive, quality, reshape, standard
from fieldledger.plans.transform import canonical_points
from fieldledger.settings import DEFAULT_COMBO, SUPERVISION_FORM, Derivations, PointRules, RunSettings

RULES = PointRules(unmapped_prefixes=("src#", "ssc"))


def test_derive(spark):
    df = spark.createDataFrame(
        [("3", 4.0, "yes"), (None, 1.0, "Yes"), ("1", None, "0"), ("2", 2.0, None)], "a string, `b-5` double, q string"
    )
    form = Derivations(sums=[["a", "b-5"]], halves=["b-5"], flags=[("q", "count yes q"), ("q", "count yes q 2")])
    got = derive.derive(df, form).select("a_plus_b-5", "b-5_divide_2", "`count yes q`", "`count yes q 2`").collect()
    assert [tuple(r) for r in got] == [(7.0, 2.0, 1, 1), (None, 0.5, None, None), (None, None, 0, 0), (4.0, 1.0, None, None)]


def test_derive_needs_its_columns(spark):
    with pytest.raises(ValueError, match="missing_one"):
        derive.derive(spark.range(1), Derivations(sums=[["id", "missing_one"]]))


def test_derive_bad_text(spark):
    df = spark.createDataFrame([("x",)], "a string")
    form = Derivations(halves=["a"])
    assert derive.derive(df, form, lenient=True).first()["a_divide_2"] is None
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        derive.derive(df, form).collect()


def test_supervision_form_names():
    assert len(SUPERVISION_FORM.sums) == 12 and len(SUPERVISION_FORM.halves) == 5 and len(SUPERVISION_FORM.flags) == 7
    assert len({n for group in SUPERVISION_FORM.sums for n in group} | set(SUPERVISION_FORM.halves)) == 34


def test_settings():
    text = '{"form_id": 858, "output_file_name": "f", "output_format": ".csv", "unmapped_prefixes": ["ssc"], "other": 1}'
    settings = RunSettings.from_json(text)
    assert settings.stage_format == "csv" and settings.unmapped_prefixes == ("ssc",) and settings.choices_to_labels


def test_yes_no_of_numbers(spark):
    df = spark.createDataFrame([(1, 1.0, True)], "i int, d double, b boolean")
    row = derive.derive(df, Derivations(flags=[("i", "fi"), ("d", "fd"), ("b", "fb")])).first()
    assert (row.fi, row.fd, row.fb) == (1, None, None)


def test_unpivot_long(spark):
    df = spark.createDataFrame([(1, 2.0, None, 3, True)], "id int, a double, b string, c int, d boolean")
    got = reshape.unpivot_long(df, ["id"]).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        [(1, "a", "2.0"), (1, "b", None), (1, "c", "3"), (1, "d", "true")], key=str
    )
    assert reshape.unpivot_long(df.select("id"), ["id"]).count() == 0


def points_frame(spark):
    rows = [
        (1, 202401, "ou1", 5.0, " ", "x"),
        (2, 202401, None, 5.0, "t", "x"),
        (3, 202401, " \t", 5.0, "t", "x"),
        (4, 202401, "src#9", 5.0, "t", "x"),
        (5, 202401, "ssc9", 5.0, "t", "x"),
        (6, 202401, "Ssc9", None, "NaN", "x"),
        (7, None, "ou1", 5.0, "t", "x"),
        (8, 209901, "ou1", 5.0, "t", "x"),
        (9, 202402, " ou2 ", float("nan"), "abc", "x"),
    ]
    return spark.createDataFrame(rows, "export_id int, periode int, reference_externe string, Num double, txt string, un string")


def mapping_frame(spark):
    return spark.createDataFrame(
        [("NUM", "dx1", ""), ("num", "dx2", "c2"), ("TXT", "dx3", None), ("absent", "dx4", None), ("un", None, "c")],
        "name string, data_element_id string, COC string",
    ).withColumns({"CC": F.lit("cc"), "Calcul": F.lit(None).cast("string")})


def test_points_stepwise_and_composite_agree(spark):
    wide, mapping = points_frame(spark), mapping_frame(spark)
    expected = [
        (202401, "ou1", "dx1", DEFAULT_COMBO, DEFAULT_COMBO, "5.0", "DATA_ELEMENT"),
        (202401, "ou1", "dx2", "c2", DEFAULT_COMBO, "5.0", "DATA_ELEMENT"),
        (202402, " ou2 ", "dx3", DEFAULT_COMBO, DEFAULT_COMBO, "abc", "DATA_ELEMENT"),
    ]
    as_of = date(2024, 2, 1)
    mapped = canonical.map_names(reshape.unpivot_long(wide, RULES.ids), mapping)
    step = canonical.as_points(canonical.keep_points(
        canonical.name_points(mapped.drop("Calcul").withColumn("Calcul", F.lit("k")), RULES), RULES, as_of))
    whole = canonical_points(wide, mapping, Derivations(), RULES, as_of)
    assert sorted(tuple(r) for r in step.collect()) == expected
    assert sorted(tuple(r) for r in whole.collect()) == expected
    assert step.schema.names == whole.schema.names


def test_points_without_targets(spark):
    empty = canonical_points(points_frame(spark), mapping_frame(spark).where("false"), Derivations(), RULES, date(2024, 2, 1))
    assert empty.count() == 0 and "VALUE" in empty.columns


def test_points_plan(spark, tmp_path):
    path = str(tmp_path / "raw")
    points_frame(spark).write.parquet(path)
    df = canonical_points(spark.read.parquet(path), mapping_frame(spark).where("name = 'TXT'"), Derivations(), RULES, date(2024, 2, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "txt" in schema and "Num" not in schema and "un:" not in schema and "export_id" not in schema
    assert "PushedFilters: [IsNotNull(periode), LessThanOrEqual(periode,202402)" in plan


def test_mapping_join_is_inner_after_null_filter(spark):
    mapped = canonical.map_names(reshape.unpivot_long(points_frame(spark), RULES.ids), mapping_frame(spark))
    kept = canonical.drop_nulls(mapped, ["data_element_id"])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan


def test_targets_beyond_the_projection_are_joined(spark):
    wide, mapping = points_frame(spark), mapping_frame(spark)
    assert reshape.read_targets(reshape.targets_of(mapping, wide.columns), wide.columns, most=2) is None

    def points(most):
        got = canonical_points(wide, mapping, Derivations(), RULES, date(2024, 2, 1), literal_targets=most)
        return Counter(tuple(r) for r in got.collect())

    assert points(2) == points(100) and points(2).total() > 2


def test_union_relaxed(spark):
    a = spark.createDataFrame([(1, 1, None)], "x int, y int, z string").withColumn("z", F.lit(None))
    b = spark.createDataFrame([(2, 2.5, 9)], "x bigint, y double, z int")
    c = spark.createDataFrame([(3, 1.0, "t")], "x int, y double, z string")
    both = reshape.union_relaxed([a, b])
    assert [f.dataType.simpleString() for f in both.schema.fields] == ["bigint", "double", "int"]
    assert sorted(tuple(r) for r in reshape.union_relaxed([b, c]).collect()) == [(2, 2.5, "9"), (3, 1.0, "t")]
    with pytest.raises(ValueError, match="differ"):
        reshape.union_relaxed([a, a.drop("z")])


def test_names(spark):
    assert columns.unique_names(["age", "age", "age_1", "b"]) == ["age_2", "age_3", "age_1", "b"]
    df = spark.createDataFrame([(1, 2)], "`Âge (ans)` int, `a.b` int")
    assert columns.clean_columns(df).columns == ["age_ans", "ab"]
    assert columns.sort_columns(columns.clean_columns(df)).columns == ["ab", "age_ans"]


def test_sorted_rows(spark):
    df = spark.createDataFrame([(2, "a"), (1, None), (1, "b"), (None, "z")], "p int, x string")
    assert [tuple(r) for r in columns.sort_rows(df).collect()] == [(None, "z"), (1, None), (1, "b"), (2, "a")]
    within = columns.sort_rows(df, within="x").collect()
    assert sorted(map(str, within)) == sorted(map(str, df.collect()))


def test_one_hot(spark):
    df = spark.createDataFrame(
        [(1, ["Déjà vu (x)", None]), (2, None), (3, []), (4, ["b", "deja vu x"])], "id int, q array<string>"
    )
    got = {r.id: (r["q_b"], r["q_deja_vu_x"]) for r in choices.one_hot(df).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (0, 0), 4: (1, 1)}
    assert dict(choices.one_hot(df).dtypes)["q_b"] == "tinyint"
    assert choices.one_hot(df.select("id")).columns == ["id"]
    known = spark.createDataFrame([("q", "b"), ("q", "c"), ("other", "d"), ("q", None)], "question string, element string")
    hot = choices.one_hot(df, elements=known)
    assert hot.columns == ["id", "q_b", "q_c", "q_others"]
    got = {r.id: (r.q_b, r.q_c, r.q_others) for r in hot.collect()}
    assert got == {1: (0, 0, {"Déjà vu (x)": 1}), 2: (0, 0, {}), 3: (0, 0, {}), 4: (1, 0, {"deja vu x": 1})}
    maps = {r.id: r.q for r in choices.choice_maps(df).collect()}
    assert maps == {1: {"Déjà vu (x)": 1}, 2: {}, 3: {}, 4: {"b": 1, "deja vu x": 1}}


def test_known_choices_need_no_job(spark):
    df = spark.createDataFrame([(["a"],)], "q array<string>").select(F.raise_error(F.lit("read")).cast("array<string>").alias("q"))
    choices.choice_maps(df)
    choices.one_hot(df, elements=spark.createDataFrame([("q", "a")], "question string, element string"))
    with pytest.raises(Exception, match="read"):
        choices.one_hot(df)


def test_labels(spark):
    df = spark.createDataFrame([("1", "a b  c"), ("2", None), (None, "")], "q string, m string")
    labels = spark.createDataFrame([("q", "1", "Oui"), ("m", "a", "A!"), ("m", "c", "C!")], "question string, code string, label string")
    got = [tuple(r) for r in choices.replace_labels(df, labels, ["m"]).collect()]
    assert got == [("Oui", ["A!", "b", "C!"]), ("2", None), (None, [])]


def test_joined_labels_are_those_of_the_lookup(spark):
    rows = [("1", "a b  c", "x"), ("2", None, "x y"), (None, "", None), ("1", "c a", " "), ("3", "zz", "y"), ("3", "c a", "y")]
    df = spark.createDataFrame(rows, "q string, `m.n` string, `_label` string")
    labels = [("q", "1", "Oui"), ("q", "1", "Aussi"), ("m.n", "a", "A!"), ("m.n", "c", "C!"), ("q", "2", None), ("none", "1", "x")]
    table = spark.createDataFrame(labels, "question string, code string, label string")

    def counted(most):
        got = choices.replace_labels(df, table, ["m.n", "_label"], literal_choices=most)
        assert got.columns == df.columns
        return Counter(str(r) for r in got.collect())

    assert counted(1) == counted(100)
    assert any("A!" in r and "Oui" in r for r in counted(1))


def test_standard(spark):
    rates = spark.createDataFrame([("ds.ACTUAL", "202401", "ou", "1"), ("ds", "202401", "ou", "2")], "dx string, pe string, ou string, value string")
    got = standard.to_standard(rates, "REPORTING_RATE").select("DX_UID", "RATE_TYPE", "PERIOD", "ORG_UNIT").collect()
    assert [tuple(r) for r in got] == [("ds", "ACTUAL", "202401", "ou"), ("ds", None, "202401", "ou")]
    with pytest.raises(ValueError, match="data type"):
        standard.to_standard(rates, "OTHER")
    with pytest.raises(ValueError, match="dataElement"):
        standard.to_standard(rates.withColumnsRenamed({"pe": "period", "ou": "orgUnit"}))


def test_non_numeric(spark):
    df = spark.createDataFrame([("d", "1"), ("d", "x"), ("d", "b"), ("e", None), ("f", "2")], "DX_UID string, VALUE string")
    got = sorted(tuple(r) for r in quality.non_numeric_profile(df).collect())
    assert got == [("d", 2, "b"), ("e", 1, None)]
