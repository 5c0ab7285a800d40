"""Readers, writers, composite jobs and the stream, on files in temporary folders."""

import gzip
import json
import uuid
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

from fieldledger import schemas
from fieldledger.operators.delta import delta
from fieldledger.operators.hierarchy import last_units
from fieldledger.plans.align import settle_alignment, write_alignment
from fieldledger.plans.extract import check_periods, extract
from fieldledger.plans.ingest import clean_submissions, ingest
from fieldledger.plans.publish import PublishPaths, prepare_publish, settle_publish
from fieldledger.plans.quality import report_non_numeric
from fieldledger.plans.transform import transform
from fieldledger.functions.periods import in_periods
from fieldledger.session import kept, scratch_dir
from fieldledger.settings import Derivations, PointRules
from fieldledger.sinks import audit, snapshots as sink_snapshots
from fieldledger.sinks.snapshots import commit_snapshot
from fieldledger.sinks.stages import replace_parquet, write_stage, write_table
from fieldledger.sources import landed, paths, snapshots, tabular
from fieldledger.streaming import incoming
from fieldledger.streaming.incoming import publish_incoming


def types(df):
    return dict(df.dtypes)


def test_csv_types_fit_all_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Âge,n,f,b,t,e,t\n1,1,1.5,true,x,,u\n2,,2,false,"a ""q"",\nb",,v\nx,9999999999,3,no,z,,w\n', encoding="utf-8")
    df = tabular.read_csv(spark, str(path))
    assert df.columns == ["Âge", "n", "f", "b", "t", "e", "t_duplicated_0"]
    assert [t for _, t in df.dtypes] == ["string", "bigint", "double", "string", "string", "string", "string"]
    rows = [tuple(r) for r in df.collect()]
    assert rows[1] == ("2", None, 2.0, "false", 'a "q",\nb', None, "v")
    assert rows[2] == ("x", 9999999999, 3.0, "no", "z", None, "w")


def test_csv_fetches_keep_every_cell(spark, tmp_path):
    (tmp_path / "a +%20b.csv").write_text("k,v\n1,2\n")
    (tmp_path / "b.csv").write_text("k,v\n2,2.5\n")
    (tmp_path / "c.csv").write_text("k,v\n")
    (tmp_path / "d.csv").write_text('w,"k ""\nx",k\n"a\nb",,007\n')
    (tmp_path / "e.csv").write_text("")
    files = [str(tmp_path / f"{n}.csv") for n in ("a +%20b", "b", "c", "d", "e")]
    df = tabular.read_csv_fetches(spark, files)
    assert types(df) == {"k": "string", "v": "string", "w": "string", 'k "\nx': "string"}
    got = df.select("k", "v", "w").collect()
    assert sorted(map(tuple, got)) == [("007", None, "a\nb"), ("1", "2", None), ("2", "2.5", None)]
    assert tabular.read_csv_fetches(spark, files[2:3]) is None
    assert tabular.read_csv_fetches(spark, files[4:]) is None
    known = tabular.read_csv(spark, files[0], schema="k int, v string")
    assert [tuple(r) for r in known.collect()] == [(1, "2")]


def test_number_of_jobs_does_not_follow_the_files(spark, tmp_path):
    def jobs(count):
        folder = tmp_path / str(count)
        folder.mkdir()
        for i in range(count):
            (folder / f"{i}.csv").write_text(f"periode,a\n2024{1 + i % 12:02},{i}\n")
        group = f"ingest-{count}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert ingest(spark, [str(folder / f"{i}.csv") for i in range(count)], str(folder / "raw"))
        finally:
            spark.sparkContext.setJobGroup("", "")
        assert tabular.read_stage(spark, str(folder / "raw")).count() == count
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert 0 < jobs(24) <= jobs(2) + 2


def test_ingest_selects_periods(spark, tmp_path):
    (tmp_path / "a.csv").write_text("periode,a\n" + "".join(f"{p},{p % 10}\n" for p in range(202401, 202407)))
    for name, asked, want in (
        ("one", {"only": 202402}, [202402]),
        ("list", {"periods": [202401, 202405]}, [202401, 202405]),
        ("range", {"start": 202403, "end": 202404}, [202403, 202404]),
        ("since", {"updated_since": "4", "updated": "a"}, [202404, 202405, 202406]),
    ):
        assert ingest(spark, [str(tmp_path / "a.csv")], str(tmp_path / name), multi_line=False, **asked)
        assert paths.list_periods(spark, str(tmp_path / name)) == want


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_stage_keeps_columns_and_types_of_every_period(spark, tmp_path, file_format):
    path = str(tmp_path / "stage")
    write_stage(spark.sql("SELECT 202401 AS PERIOD, 1L AS x, 'p' AS q_a"), path, file_format)
    write_stage(spark.sql("SELECT 202402 AS PERIOD, 2.5D AS x, 9L AS q_b"), path, file_format)
    df = tabular.read_stage(spark, path, file_format)
    assert types(df) == {"x": "double", "q_a": "string", "q_b": "bigint", "PERIOD": "int"}
    want = [(202401, 1.0, "p", None), (202402, 2.5, None, 9)]
    assert sorted(map(tuple, df.select("PERIOD", "x", "q_a", "q_b").collect())) == want
    write_stage(spark.sql("SELECT 202403 AS PERIOD, 'text' AS x"), path, file_format)
    third = tabular.read_stage(spark, path, file_format, only=202403).select("x", "q_a", "q_b")
    assert [tuple(r) for r in third.collect()] == [("text", None, None)]


def test_stage_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([(202401, "a"), (202402, "b"), (None, "c")], "PERIOD int, x string")
    write_stage(df, path)
    write_stage(df.where("PERIOD = 202402").withColumn("x", F.lit("B")), path)
    write_stage(df.where("false"), path)
    assert sorted(tuple(r) for r in tabular.read_stage(spark, path).select("PERIOD", "x").collect()) == [(202401, "a"), (202402, "B")]
    assert paths.list_periods(spark, path) == [202401, 202402]
    plan = tabular.read_stage(spark, path, only=202401)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(PERIOD" in plan
    with pytest.raises(ValueError, match="file format"):
        tabular.read_stage(spark, path, "xlsx")
    with pytest.raises(ValueError, match="file format"):
        write_stage(df, path, "xlsx")
    assert tabular.read_stage(spark, str(tmp_path / "absent")) is None


def test_flat_stage_takes_the_period_from_the_name(spark, tmp_path):
    import pandas as pd

    for period in (202401, 202402):
        pd.DataFrame({"x": [period]}).to_parquet(tmp_path / f"form_v3_{period}.parquet")
        (tmp_path / f"form_v3_{period}.csv").write_text(f"x\n{period}\n")
    pd.DataFrame({"x": [1]}).to_parquet(tmp_path / "other.parquet")
    for file_format in ("parquet", "csv"):
        df = tabular.read_flat_stage(spark, str(tmp_path), file_format)
        assert sorted((int(r.x), r.PERIOD) for r in df.collect()) == [(202401, 202401), (202402, 202402)]
    assert tabular.read_flat_stage(spark, str(tmp_path), only=202402).count() == 1
    assert tabular.read_flat_stage(spark, str(tmp_path), periods=[202405]) is None
    # Files of other periods are not opened: this one is no Parquet at all.
    (tmp_path / "form_v3_202403.parquet").write_text("x")
    assert tabular.read_flat_stage(spark, str(tmp_path), periods=[202401, 202402]).count() == 2


def test_replace_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(spark.range(3), path)
    replace_parquet(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        replace_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_table_export(spark):
    write_table(spark.range(2), "exported")
    write_table(spark.range(3), "exported", "append")
    assert spark.table("exported").count() == 5
    with pytest.raises(ValueError, match="Schema"):
        write_table(spark.range(1).selectExpr("cast(id as string) id"), "exported", "append")
    write_table(spark.range(1), "exported")
    assert spark.table("exported").count() == 1
    with pytest.raises(ValueError, match="save mode"):
        write_table(spark.range(1), "exported", "other")


def test_landed_units_keep_their_order(spark, tmp_path):
    names = {"a.json": [("x", "older"), ("y", "z"), ("x", "later")], "b.json": [("y", "a"), ("z", "b"), ("z", "a")]}
    for file, rows in names.items():
        (tmp_path / file).write_text(json.dumps([{"id": i, "name": n} for i, n in rows], indent=1))
    units = landed.read_units(spark, str(tmp_path))
    assert units.columns == schemas.ORG_UNIT.names
    assert {r.id: r.name for r in last_units(units).collect()} == {"x": "later", "y": "a", "z": "a"}


def test_landed_json(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps([{"name": "Q", "data_element_id": "dx", "COC": None, "other": 1}], indent=1))
    assert landed.read_mapping(spark, str(tmp_path / "map.json")).first().data_element_id == "dx"
    (tmp_path / "ou.json").write_text(json.dumps([{"id": "a", "parent": {"id": "p"}, "geometry": {"type": "Point", "coordinates": [1]}}]))
    assert landed.read_units(spark, str(tmp_path / "ou.json")).first().parent.id == "p"
    docs = tmp_path / "reg"
    docs.mkdir()
    for name, unit in (("a", "u1"), ("b", "u2")):
        rows = [{"organisationUnit": unit, "period": "202401", "completed": c, "date": d} for c, d in ((True, "1"), (False, "2"))]
        (docs / f"{name}.json").write_text(json.dumps({"completeDataSetRegistrations": rows}, indent=2))
    (docs / "c.json").write_text("{}")
    rows = landed.read_registrations(spark, str(docs)).orderBy("seq").collect()
    assert [(r.organisationUnit, r.date) for r in rows] == [("u1", "1"), ("u1", "2"), ("u2", "1"), ("u2", "2")]
    (tmp_path / "choices.json").write_text(json.dumps([{"question": "q", "code": "1", "label": "Oui"}]))
    assert landed.read_choices(spark, str(tmp_path / "choices.json")).first().label == "Oui"
    (tmp_path / "resp.json").write_text(json.dumps({"batch_id": "b", "status_code": 200, "body": '{"a":1}'}) + "\n")
    assert landed.read_responses(spark, str(tmp_path / "resp.json")).first().body == '{"a":1}'


def test_units_have_the_schema_of_units(spark, tmp_path):
    for name in ("a", "b +%20c"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"id": name}, {"id": name + "2"}]))
    units = landed.read_units(spark, str(tmp_path))
    assert dict(units.dtypes)["seq"] == "bigint"
    table = spark.createDataFrame([("z", -1)], "id string, seq long")
    both = units.select("id", "seq").unionByName(table)
    assert [r.id for r in both.orderBy("seq").collect()] == ["z", "a", "a2", "b +%20c", "b +%20c2"]


def test_large_documents_are_read_in_pieces(spark, tmp_path):
    """Many small splits of one file; files with braces in texts, other layouts and no list beside it."""
    def row(i, date="2024"):
        return {"organisationUnit": f"u{i}", "period": "202401", "completed": i % 2 == 0, "date": date, "dataSet": 'a "b" [c], d'}

    rows = {"a": [row(i) for i in range(500)], "b": [row(0, "x}y{"), row(1)], "c +%20d": [row(2), row(3)], "e": [], "f": [row(9)]}
    texts = {n: json.dumps({"completeDataSetRegistrations": r}, indent=3 if n == "a" else None) for n, r in rows.items()}
    texts["f"] = json.dumps({"pager": {"page": 1}, "completeDataSetRegistrations": rows["f"]})
    texts["g"], texts["h"], texts["i"] = "{}", '{"completeDataSetRegistrations": null}\n', " "
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = landed.read_registrations(spark, str(tmp_path))
        got = df.orderBy("seq").collect()
        assert df.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [r for name in sorted(rows) for r in rows[name]]
    assert [{k: r[k] for k in row(0)} for r in got] == want
    assert [r.seq._pos for r in got if r.organisationUnit in ("u0", "u1") and "b.json" in r.seq._file] == [0, 1]


def test_stored_counts(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert audit.read_counts(spark, path).count() == 0
    audit.write_counts(points_of(spark, (202401, "a", "1"), (202401, "a", "2"), (202402, "b", "1")), path, "transformed", [202401, 202402])
    audit.write_counts(points_of(spark, (202401, "a", "1")), path, "pushed", [202401])
    audit.write_counts(points_of(spark), path, "transformed", [202402])
    assert [tuple(r) for r in audit.read_counts(spark, path).collect()] == [(202401, "a", 0, 2, 1)]
    assert audit.read_counts(spark, path, 202402).count() == 0
    assert audit.read_counts(spark, path).schema == schemas.AUDIT
    with pytest.raises(ValueError, match="stage"):
        audit.write_counts(points_of(spark), path, "other", [])


def test_processed_log(spark, tmp_path):
    assert landed.read_processed(spark, str(tmp_path / "absent")).count() == 0
    spark.range(1).withColumn("PERIOD", F.lit(1)).write.parquet(str(tmp_path / "odd"))
    assert landed.read_processed(spark, str(tmp_path / "odd")).count() == 0


def test_audit_read(spark, tmp_path):
    rows = [(202401, "a", 1, 1, 1), (202402, "a", 1, 1, 1)]
    spark.createDataFrame(rows, schemas.AUDIT).write.parquet(str(tmp_path / "audit"))
    assert landed.read_audit(spark, str(tmp_path / "audit"), 202401).count() == 1


def test_extract(spark, tmp_path):
    source, out = str(tmp_path / "landed"), str(tmp_path / "out")
    rows = [(d, p, u, "c", "a", "1") for d in ("d1", "d2") for p in ("202401", "202402") for u in ("u1", "u2")]
    spark.createDataFrame(rows, schemas.DATA_ELEMENT_VALUES).write.parquet(source)
    done = extract(spark, source, out, "DATA_ELEMENT", ["d1"], ["u1"], [202401, 202403])
    assert done == {202401: f"{out}/PERIOD=202401", 202403: None}
    assert extract(spark, source, out, "DATA_ELEMENT", ["d1", "d2"], ["u1"], [202401, 202402], "DOWNLOAD_NEW") == {
        202401: None, 202402: f"{out}/PERIOD=202402",
    }
    kept = extract(spark, source, out, "DATA_ELEMENT", ["d1"], ["u1"], [202401], "DOWNLOAD_NEW", return_existing=True)
    assert kept == {202401: f"{out}/PERIOD=202401"}
    got = tabular.read_stage(spark, out)
    assert sorted((r.PERIOD, r.DX_UID) for r in got.collect()) == [(202401, "d1"), (202402, "d1"), (202402, "d2")]
    with pytest.raises(ValueError, match="202413"):
        check_periods(spark, [202401, 202413])
    with pytest.raises(ValueError, match="download mode"):
        extract(spark, source, out, "DATA_ELEMENT", ["d1"], ["u1"], [202401], "OTHER")
    analytics = spark.createDataFrame([("i1", "202401", "u1", "3")], schemas.ANALYTICS_VALUES)
    analytics.write.mode("overwrite").json(str(tmp_path / "an"))
    units = spark.createDataFrame([("u1",)], "id string")
    done = extract(spark, str(tmp_path / "an"), str(tmp_path / "out2"), "INDICATOR", ["i1"], units, [202401], file_format="json")
    assert done[202401] and extract(spark, str(tmp_path / "none"), str(tmp_path / "o3"), "INDICATOR", [], [], [202401]) == {202401: None}


CSV = """export_id,instanceid,periode,reference_externe,Nombre (a),b,Choix,Oui?
1,i1,202401,ou1,1,2.5,x y,yes
2,i2,202401,src#7,1,1,x,no
3,i3,202402,ou2,4,,z,0
4,i4,,ou3,4,1,z,1
"""
MAPPING = [
    {"name": "nombre_a_plus_b", "data_element_id": "dxSum", "COC": ""},
    {"name": "Choix_Ix", "data_element_id": "dxChoice", "COC": "c1"},
    {"name": "count yes oui", "data_element_id": "dxYes", "COC": None},
]


def whole_run(spark, tmp_path, file_format):
    base = tmp_path / file_format
    base.mkdir()
    (base / "fetch.csv").write_text(CSV)
    (base / "map.json").write_text(json.dumps(MAPPING))
    choices = spark.createDataFrame([("Choix", "x", "Ix"), ("Choix", "y", "Ypsilon é")], schemas.CHOICES)
    raw, done = str(base / "raw"), str(base / "transformed")
    assert ingest(spark, [str(base / "fetch.csv")], raw, file_format, choices, ["Choix"])
    form = Derivations(sums=[["nombre_a", "b"]], flags=[("oui", "count yes oui")])
    mapping = landed.read_mapping(spark, str(base / "map.json"))
    rules = PointRules(unmapped_prefixes=("src#",))
    assert transform(spark, raw, done, mapping, form, rules, date(2024, 3, 1), file_format, audit_path=str(base / "audit"))
    counts = sorted(tuple(r) for r in audit.read_counts(spark, str(base / "audit")).collect())
    assert counts == [(202401, "ou1", 1, 3, 0), (202401, "src#7", 1, 0, 0), (202402, "ou2", 1, 2, 0)]
    return raw, done


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_form_to_points(spark, tmp_path, file_format):
    raw, done = whole_run(spark, tmp_path, file_format)
    columns = tabular.read_stage(spark, raw, file_format).columns
    assert columns[:-1] == sorted(columns[:-1]) and "choix_ypsilon_e" in columns
    assert paths.list_periods(spark, raw) == [202401, 202402]
    got = tabular.read_stage(spark, done, file_format, schema=schemas.POINT)
    assert sorted((r.PERIOD, r.ORG_UNIT, r.DX_UID, r.VALUE) for r in got.collect()) == [
        (202401, "ou1", "dxChoice", "1"), (202401, "ou1", "dxSum", "3.5"), (202401, "ou1", "dxYes", "1"),
        (202402, "ou2", "dxChoice", "0"), (202402, "ou2", "dxYes", "0"),
    ]


def jobs_of(spark, run):
    """Numbers of stages of the jobs that ``run`` starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    return [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup(group)]


def test_headers_are_found_without_a_job(spark, tmp_path):
    plain, packed, spaced, other, empty, quotes = (str(tmp_path / n) for n in ("a b+%.csv", "b.csv.gz", "c.csv", "d.csv", "e.csv", "f.csv"))
    Path(plain).write_text("x,é\r\n1,2\r\n", newline="")
    with gzip.open(packed, "wt", encoding="utf-8") as file:
        file.write("x,é\n3,4\n")
    Path(spaced).write_text("\n  \n\ufeffx,é\n")
    Path(other).write_text("\ufeffx,y\n5,6\n")
    Path(empty).write_text("")
    Path(quotes).write_text('x,"a\nb"\n')
    groups = []
    assert jobs_of(spark, lambda: groups.extend(tabular.header_groups(spark, [str(tmp_path)]))) == []
    found = sorted([file.removeprefix("file://") for file in group] for group in groups)
    assert found == [[plain, packed], [spaced], [other], [quotes]]


def test_points_of_a_stage_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    raw, done, joined = (str(tmp_path / n) for n in ("raw", "done", "joined"))
    rows = spark.range(400).selectExpr("id AS export_id", "CAST(202401 + id % 12 AS INT) AS periode", "concat('u', id) AS reference_externe", "CAST(id AS STRING) AS q")
    write_stage(rows, raw, period="periode")
    mapping = spark.createDataFrame([("q", "dxQ", None, None, None), ("Q", "dxR", None, None, None)], schemas.MAPPING)
    arguments = (mapping, Derivations(), PointRules(()), date(2024, 12, 31))
    assert max(jobs_of(spark, lambda: transform(spark, raw, done, *arguments))) == 1
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    # Joined targets may shuffle the rows, which are then gathered.
    monkeypatch.setattr("fieldledger.plans.transform.LITERAL_TARGETS", 0)
    assert max(jobs_of(spark, lambda: transform(spark, raw, joined, *arguments))) > 1
    read = [sorted(tuple(r) for r in tabular.read_stage(spark, path, schema=schemas.POINT).collect()) for path in (done, joined)]
    assert read[0] == read[1] and len(read[0]) == 800
    assert paths.list_periods(spark, done) == [202400 + m for m in range(1, 13)]
    assert all(len(list(Path(done, f"PERIOD={202400 + m}").glob("*.parquet"))) == 1 for m in range(1, 13))


def test_ingest_without_data(spark, tmp_path):
    (tmp_path / "e.csv").write_text("periode,a\n")
    assert not ingest(spark, [str(tmp_path / "e.csv")], str(tmp_path / "raw"))
    assert not Path(tmp_path / "raw").exists()
    assert not transform(spark, str(tmp_path / "raw"), str(tmp_path / "t"), spark.createDataFrame([], schemas.MAPPING), Derivations(), PointRules(()), date(2024, 1, 1))


def test_clean_submissions_names(spark):
    df = spark.createDataFrame([(1, 2, ["a"])], "`É` int, e int, l array<string>")
    assert clean_submissions(df).columns == ["e_1", "e_2", "l_a"]


def test_publish_and_settle(spark, tmp_path):
    _, done = whole_run(spark, tmp_path, "parquet")
    pushed = str(tmp_path / "pushed")
    first = PublishPaths(str(tmp_path / "run1"))
    totals = prepare_publish(spark, done, pushed, first, size=2, dry_run=False)
    assert totals == {"all": 5, "changes": 5, "new": 5, "changed": 0, "removed": 0, "valid": 5, "delete": 0, "ignored": 0}
    payloads = spark.read.json(first.payloads).collect()
    assert sorted(p.n_points for p in payloads) == [1, 2, 2]
    sent = [v for p in payloads for v in json.loads(p.payload)["dataValues"]]
    assert {v["dataElement"] for v in sent} == {"dxChoice", "dxSum", "dxYes"}

    def reply(paths, reject):
        batched = spark.read.parquet(paths.points)
        bad = F.collect_list(F.when(F.col("dataElement") == reject, F.col("batch_pos"))).alias("rejectedIndexes")
        grouped = batched.groupBy("batch_id").agg(bad, F.count(F.lit(1)).alias("imported"))
        response = F.struct(F.struct("imported").alias("importCount"), "rejectedIndexes").alias("response")
        return grouped.select("batch_id", F.lit(200).alias("status_code"), F.to_json(F.struct(response)).alias("body"))

    server_error = spark.createDataFrame([("x", 500, "{}")], schemas.RESPONSE)
    with pytest.raises(RuntimeError, match="500"):
        settle_publish(spark, done, pushed, first, server_error, False)
    assert settle_publish(spark, done, pushed, first, reply(first, "none"), True)["imported"] == 5
    assert not paths.path_exists(spark, pushed)
    settled = settle_publish(spark, done, pushed, first, reply(first, "dxSum"), False)
    assert (settled["imported"], settled["rejected"], settled["held"]) == (5, 1, 1)
    assert spark.read.parquet(first.rejected).count() == 1
    second = PublishPaths(str(tmp_path / "run2"))
    assert prepare_publish(spark, done, pushed, second, dry_run=False)["new"] == 1
    settle_publish(spark, done, pushed, second, reply(second, "none"), False)
    # Nothing of an earlier run is left to be sent, be it that nothing changed or that there is no stage.
    for root, stage in ((first, done), (second, str(tmp_path / "absent"))):
        assert prepare_publish(spark, stage, pushed, root)["changes"] == 0
        assert [spark.read.schema("batch_id string").parquet(p).count() for p in (root.changes, root.points, root.ignored, root.deleted)] == [0] * 4
        assert not [f for f in Path(root.payloads).glob("*.json") if f.read_text()]
        none = spark.createDataFrame([], schemas.RESPONSE)
        assert settle_publish(spark, stage, pushed, root, none, False)["responses"] == 0
    assert tabular.read_stage(spark, pushed, schema=schemas.POINT).count() == 5
    assert report_non_numeric(spark, done, str(tmp_path / "report")) and not report_non_numeric(spark, str(tmp_path / "absent"), "x")


def test_alignment_run(spark, tmp_path):
    rows = [("a", "n", "s", "2020", None, ("p",), 1, "/a", None, 1)]
    source = spark.createDataFrame(rows, schemas.ORG_UNIT)
    actions = write_alignment(source, source.where("false"), str(tmp_path / "actions"))
    answers = spark.createDataFrame([("CREATE", "a", 201, '{"status":"OK"}')], "action string, ou_id string, status_code int, body string")
    totals = settle_alignment(actions, answers, str(tmp_path / "report"))
    assert [tuple(r) for r in totals.collect()] == [("CREATE", "OK", 1)]


def accept_all(epoch, paths):
    """A good answer to every batch."""
    batched = SparkSession.getActiveSession().read.parquet(paths.points).select("batch_id").distinct()
    return batched.select("batch_id", F.lit(200).alias("status_code"), F.lit("{}").alias("body"))


def test_stream_equals_batch_and_takes_each_file_once(spark, tmp_path):
    landing, pushed, out, state = (str(tmp_path / n) for n in ("in", "pushed", "out", "state"))
    def points(rows):
        return spark.createDataFrame([(p, u, "dx", "c", "a", v, "DATA_ELEMENT") for p, u, v in rows], schemas.POINT).coalesce(1)

    def run():
        publish_incoming(spark, landing, schemas.POINT, lambda df: df, pushed, out, state, accept_all, size=2).awaitTermination()

    points([(202401, "a", "1"), (202401, "b", "1"), (202402, "a", "1")]).write.mode("append").parquet(landing)
    run()
    run()
    points([(202401, "a", "2"), (202401, "c", "1")]).write.mode("append").parquet(landing)
    run()
    snapshot = tabular.read_stage(spark, pushed, schema=schemas.POINT)
    assert sorted((r.PERIOD, r.ORG_UNIT, r.VALUE) for r in snapshot.collect()) == [
        (202401, "a", "2"), (202401, "b", "1"), (202401, "c", "1"), (202402, "a", "1"),
    ]
    published = spark.read.parquet(f"{out}/epoch=0/points", f"{out}/epoch=1/points")
    assert published.count() == 5
    assert sorted(p.name for p in Path(out).iterdir()) == ["epoch=0", "epoch=1"]
    assert delta(snapshot, snapshot).count() == 0


def test_stream_sends_unaccepted_points_again(spark, tmp_path):
    landing, pushed, out, state = (str(tmp_path / n) for n in ("in", "pushed", "out", "state"))
    bodies = {
        (0, 202401): '{"response":{"rejectedIndexes":[0]}}',
        (1, 202401): "{}", (1, 202402): '{"status":"ERROR"}', (1, 202403): "{}",
        (2, 202402): "{}", (2, 202404): "{}",
    }

    def answers(epoch, paths):
        sent = spark.read.parquet(paths.points).select("batch_id", "period").distinct().collect()
        rows = [(r.batch_id, 200, bodies[epoch, r.period]) for r in sent if (epoch, r.period) in bodies]
        return spark.createDataFrame(rows, schemas.RESPONSE)

    def run(rows):
        points = spark.createDataFrame([(p, u, "dx", "c", "a", v, "DATA_ELEMENT") for p, u, v in rows], schemas.POINT)
        points.coalesce(1).write.mode("append").parquet(landing)
        publish_incoming(spark, landing, schemas.POINT, lambda df: df, pushed, out, state, answers).awaitTermination()
        snapshot = tabular.read_stage(spark, pushed, schema=schemas.POINT)
        found = snapshot.collect() if snapshot is not None else []
        return sorted((r.PERIOD, r.ORG_UNIT, r.VALUE) for r in found)

    assert run([(202401, "a", "1"), (202402, "a", "1"), (202402, "b", "1")]) == []
    assert run([(202403, "a", "1")]) == [(202401, "a", "1"), (202403, "a", "1")]
    assert run([(202404, "a", "1"), (202402, "b", "2")]) == [
        (202401, "a", "1"), (202402, "a", "1"), (202402, "b", "2"), (202403, "a", "1"), (202404, "a", "1"),
    ]
    assert incoming.retry_pending(spark, pushed, out, accept_all) is None
    sent = spark.read.parquet(f"{out}/epoch=2/points")
    assert sorted((r.period, r.orgUnit, r.value) for r in sent.collect()) == [(202402, "a", "1"), (202402, "b", "2"), (202404, "a", "1")]


def test_pending_points_are_sent_without_a_file(spark, tmp_path):
    landing, pushed, out, state = (str(tmp_path / n) for n in ("in", "pushed", "out", "state"))
    rows = [(p, u, "dx", "c", "a", "1", "DATA_ELEMENT") for p in (202401, 202402, 202403) for u in "ab"]
    rows.append((None, "a", "dx", "c", "a", "1", "DATA_ELEMENT"))
    spark.createDataFrame(rows, schemas.POINT).coalesce(1).write.parquet(landing)

    def only(*good):
        return lambda epoch, paths: accept_all(epoch, paths).where(F.substring("batch_id", 1, 6).isin([str(p) for p in good]))

    def fails(epoch, paths):
        raise RuntimeError("no transport")

    def posted():
        return sorted({r.PERIOD for r in tabular.read_stage(spark, pushed, schema=schemas.POINT).collect()})

    publish_incoming(spark, landing, schemas.POINT, lambda df: df, pushed, out, state, only(202401)).awaitTermination()
    assert posted() == [202401]
    with pytest.raises(RuntimeError, match="no transport"):
        incoming.retry_pending(spark, pushed, out, fails)
    assert posted() == [202401] and incoming.read_pending(spark, out, 0).count() == 4
    totals = incoming.retry_pending(spark, pushed, out, only(202402))
    assert (totals["held"], totals["responses"]) == (2, 1) and posted() == [202401, 202402]
    more = [(202404, "a", "dx", "c", "a", "1", "DATA_ELEMENT")]
    spark.createDataFrame(more, schemas.POINT).coalesce(1).write.mode("append").parquet(landing)
    publish_incoming(spark, landing, schemas.POINT, lambda df: df, pushed, out, state, only(202404)).awaitTermination()
    assert posted() == [202401, 202402, 202404]
    assert incoming.retry_pending(spark, pushed, out, accept_all)["held"] == 0
    assert posted() == [202401, 202402, 202403, 202404]
    assert incoming.retry_pending(spark, pushed, out, accept_all) is None


def points_of(spark, *rows):
    return spark.createDataFrame([(p, u, "dx", "c", "a", v, "DATA_ELEMENT") for p, u, v in rows], schemas.POINT)


def test_snapshot_versions(spark, tmp_path):
    """A commit replaces, adds and drops periods at once; a plain stage found there is taken over."""
    path = str(tmp_path / "pushed")

    def rows(**which):
        df = snapshots.read_snapshot(spark, path, schemas.POINT, **which)
        return None if df is None else sorted((r.PERIOD, r.ORG_UNIT, r.VALUE) for r in df.collect())

    assert rows() is None
    write_stage(points_of(spark, (202401, "a", "1"), (202402, "a", "1"), (202403, "a", "1")), path)
    assert rows(only=202402) == [(202402, "a", "1")]
    first = commit_snapshot(points_of(spark, (202402, "a", "2"), (202404, "a", "1")), path, [202402, 202403, 202404])
    want = [(202401, "a", "1"), (202402, "a", "2"), (202404, "a", "1")]
    assert first.version == 1 and rows() == want
    assert sorted(map(tuple, tabular.read_stage(spark, path, schema=schemas.POINT).select("PERIOD", "ORG_UNIT", "VALUE").collect())) == want
    assert rows(periods=[202401, 202404]) == [want[0], want[2]] and rows(periods=[]) is None
    with pytest.raises(ValueError, match="not to be replaced"):
        commit_snapshot(points_of(spark, (202401, "a", "9")), path, [202402])
    with pytest.raises(ValueError, match="not to be replaced"):
        commit_snapshot(points_of(spark, (None, "a", "9")), path, [202402])
    with pytest.raises(ValueError, match="schema"):
        tabular.read_stage(spark, path)
    assert rows() == want
    commit_snapshot(points_of(spark, (202401, "b", "1")), path, [202401])
    assert rows(version=1) == want and rows() == [(202401, "b", "1"), *want[1:]]
    commit_snapshot(points_of(spark), path, [202401, 202402])
    assert rows() == [(202404, "a", "1")] and snapshots.versions(spark, path) == [2, 3]
    # Folders that neither of the last two versions names are gone.
    assert not list(Path(path).glob("PERIOD=*"))
    named = {f for v in (2, 3) for f, _ in snapshots.read_manifest(spark, path, v).parts.values()}
    assert {str(p.relative_to(path)) for p in Path(path).glob("data/*/of_period=*")} == named


@pytest.mark.parametrize("dies", ["write", "publish"])
def test_a_commit_that_dies_leaves_the_old_snapshot(spark, tmp_path, monkeypatch, dies):
    path = str(tmp_path / "pushed")
    commit_snapshot(points_of(spark, (202401, "a", "1"), (202402, "a", "1")), path, [202401, 202402])
    new = points_of(spark, (202401, "a", "2"))
    if dies == "write":
        new = new.withColumn("VALUE", F.raise_error(F.lit("lost")).cast("string"))
    else:
        monkeypatch.setattr(sink_snapshots, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(Exception, match="lost|killed"):
        commit_snapshot(new, path, [202401, 202402])
    got = snapshots.read_snapshot(spark, path, schemas.POINT).collect()
    assert sorted((r.PERIOD, r.VALUE) for r in got) == [(202401, "1"), (202402, "1")]
    monkeypatch.undo()
    commit_snapshot(points_of(spark, (202401, "a", "3")), path, [202401, 202402])
    assert [(r.PERIOD, r.VALUE) for r in snapshots.read_snapshot(spark, path, schemas.POINT).collect()] == [(202401, "3")]
    assert len(list(Path(path).glob("data/*"))) == 2


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "stage")
    write_stage(points_of(spark, *[(202400 + m, "a", "1") for m in range(1, 13)]), path)
    periods = kept(points_of(spark, (202403, "x", "")).select("PERIOD"), "periods")
    found = in_periods(tabular.read_stage(spark, path, schema=schemas.POINT), periods)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.PERIOD for r in found.collect()] == [202403]


def test_scratch(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared) and scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_completion_run_spreads_its_units(spark, tmp_path):
    """Units of a small file, one scan task, are dealt out before the months multiply them."""
    from fieldledger.catalog.completion import requested

    days = "timestamp'2024-01-05 00:00:00' + make_interval(0, 0, 0, cast(id * 40 as int)) AS o_orderdate"
    spark.range(4).selectExpr(days).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(200).selectExpr("id AS c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    units = requested(spark, str(tmp_path))
    assert units.count() == units.distinct().count() == 200 * 5
    assert units.rdd.getNumPartitions() > 1


def test_settled_completion_joins_only_sent_units(spark, tmp_path):
    from fieldledger.plans.completion import settle_completion

    rows = [(202401, "a", "ready"), (202401, "b", "ready"), (202401, "c", "no_completion"), (202401, "d", "missing_keys"), (202401, None, "no_completion")]
    plan = spark.createDataFrame(rows, "PERIOD int, ORG_UNIT string, outcome string")
    # An answer for a unit that was not sent counts for nothing.
    body = '{"status":"SUCCESS","importCount":{"imported":1}}'
    replies = spark.createDataFrame([(202401, u, 200, body) for u in "ac"], "PERIOD int, ORG_UNIT string, status_code int, body string")
    settle_completion(spark, plan, replies, None, f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out/outcomes").collect()
    assert sorted(((r.ORG_UNIT, r.outcome, r.push_errors) for r in got), key=str) == sorted(
        [("a", "pushed", 0), ("b", "parse_failed", 1), ("c", "no_completion", 0), ("d", "missing_keys", 1), (None, "no_completion", 0)], key=str
    )
