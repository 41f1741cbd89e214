import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from eventloom import queries
from eventloom.errors import SpecError
from eventloom.plans.lint import lint
from eventloom.plans.run import compile_cohort, run_pipeline
from eventloom.plans.spec import DateTimeSpec, EventSpec, FileSpec, FillSpec, LookupSpec, MeltSpec, PartsSpec, PipelineSpec, TableSpec, from_dict
from eventloom.plans.tables import compile_table, early_subjects
from eventloom.sources import read_table, save
from eventloom.streaming.ingest import ingest

DAY = dt.datetime(2021, 1, 2)


@pytest.fixture()
def raw(spark, tmp_path):
    def put(name, data, schema, sep="|"):
        spark.createDataFrame(data, schema).coalesce(1).write.options(header=True, sep=sep, encoding="ISO-8859-1").csv(str(tmp_path / name))
        return FileSpec(str(tmp_path / name), sep=sep, encoding="ISO-8859-1", file_format="csv")

    patients = put("patients.csv", [("p1", "K"), ("p2", "M"), (None, "K")], "CPR string, `Køn` string")
    contacts = put("contacts.csv", [("c1", "p1", "2021-01-02"), ("c2", "p2", "2021-01-02"), ("c3", "p9", "2021-01-02"), ("c1", "p1", "2021-01-02")], "contact string, person string, ended string")
    diagnoses = put("diag.csv", [("c1", "D1", "A"), ("c2", "D2", None), ("c3", "D3", "B"), ("c4", "D4", "B")], "contact string, code string, kind string")
    stays = put("stays.csv", [("p1", "2021-01-02", None, "01", "9.7", "5"), ("p2", "2021-01-02", "x", "07", None, None)], "CPR string, day string, code string, ward string, h string, m string")
    return patients, contacts, diagnoses, stays


def spec(raw):
    patients, contacts, diagnoses, stays = raw
    looks = (LookupSpec(contacts, "contact_id", "contact", {"person": "subject_id"}), LookupSpec(contacts, "contact_id", "contact", {"ended": "timestamp"}))
    tables = {
        "diagnoses": TableSpec(diagnoses, {"contact": "contact_id", "code": "code", "kind": "kind"}, lookups=looks, code_prefix="RD/", unroll={"kind": "KIND/"}, keep_code=True),
        "stays": TableSpec(
            stays, {"CPR": "subject_id", "day": "day", "code": "code", "ward": "ward", "h": "h", "m": "m"}, strip_zeros=("ward",), value_maps={"ward": {"1": "W1", "7": "W7"}},
            fill=(FillSpec("code", "ward"),), parts=(PartsSpec("timestamp", "day", "h", "m"),), code_prefix="S/",
        ),
        "broken": TableSpec(FileSpec("/no/such/file.csv"), {"a": "code"}),
    }
    events = {"subject": {"gender": EventSpec(["GENDER", "col(gender)"])}, "diagnoses": {"d": EventSpec("col(code)", "col(timestamp)")}}
    return PipelineSpec(patients, {"CPR": "subject_id", "Køn": "gender"}, tables, events)


def test_pipeline_end_to_end(spark, raw, tmp_path):
    reports = {r.table: r for r in run_pipeline(spark, spec(raw), str(tmp_path / "out"))}
    assert {k: (r.status, r.rows) for k, r in reports.items()} == {"subject": ("written", 2), "diagnoses": ("written", 3), "stays": ("written", 2), "broken": ("failed", None)}
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert rows(read("id_map")) == [("p1", 2), ("p2", 3)]
    assert {tuple(r) for r in read("diagnoses").select("subject_id", "code", "timestamp").collect()} == {(2, "RD/D1", DAY), (2, "KIND/A", DAY), (3, "RD/D2", DAY)}
    assert {(r.subject_id, r.code, r.timestamp) for r in read("stays").collect()} == {(2, "S/W1", dt.datetime(2021, 1, 2, 9, 5)), (3, "S/x", DAY)}
    cohort = compile_cohort(spec(raw), {"subject": read("subject"), "diagnoses": read("diagnoses")})
    assert cohort.count() == 5 and cohort.dtypes == [("subject_id", "bigint"), ("time", "timestamp_ntz"), ("code", "string"), ("numeric_value", "float")]
    with pytest.raises(Exception, match="no/such/file"):
        run_pipeline(spark, spec(raw), str(tmp_path / "strict"), strict=True)


def test_chained_lookups_multiply_and_combined_do_not(spark, raw):
    table = spec(raw).tables["diagnoses"]
    more = {f: getattr(table, f) for f in ("file", "rename", "lookups")}
    one = compile_table(spark, TableSpec(**more, dedupe=False)).filter("code = 'D1'").count()
    two = compile_table(spark, TableSpec(**more, dedupe=False, combine_lookups=False)).filter("code = 'D1'").count()
    assert (one, two) == (2, 4)


def test_plans_are_native_and_read_once(spark, raw):
    df = compile_table(spark, spec(raw).tables["diagnoses"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("FileScan") == 2


def test_melt_and_date_times(spark):
    raw = spark.createDataFrame([("1", "a", "2021-01-02", "10:00:00", "2021-01-03 00:00:00")], "s string, c string, d string, t string, out string")
    first = compile_table(spark, TableSpec(FileSpec("x"), {"s": "subject_id", "c": "code", "d": "d", "t": "t", "out": "out"}, date_times=(DateTimeSpec("in", "d", "t"),), times=("out",)), raw=raw)
    second = compile_table(spark, TableSpec(FileSpec("x"), {c: c for c in first.columns}, melt=(MeltSpec({"in": "I/", "out": "O/"}),)), raw=first)
    assert {(r.code, r.timestamp) for r in second.collect()} == {("I/a", dt.datetime(2021, 1, 2, 10)), ("O/a", dt.datetime(2021, 1, 3))}


def test_ids_are_mapped_early_only_where_it_changes_nothing(spark, raw):
    rng = random.Random(5)
    data = [(rng.choice(["p1", "p2", "p9", None]), rng.choice(["p1", "p2", "p9", None]), rng.choice(["c1", "c2", "c3", None]), rng.choice(["A", None]), rng.choice(["2021-01-02", "bad", None])) for _ in range(60)]
    df = spark.createDataFrame(data, "a string, b string, c string, k string, t string")
    side = spark.createDataFrame([("p1", "x", "c1"), ("p2", "y", "c2"), ("p2", "z", "p1"), (None, "n", None)], "key string, v string, w string")
    ids = spark.createDataFrame([("p1", 2), ("p2", 3), ("p1:s", 4)], "source_id string, subject_id long")
    file, seen = FileSpec("side.csv"), set()
    for _ in range(40):
        names = {"a": "subject_id", "b": "other", "c": "contact", "k": "code", "t": "timestamp"}
        targets = {"v": rng.choice(["v", "v", "subject_id"])}
        looks = [LookupSpec(file, rng.choice(["subject_id", "contact"]), rng.choice(["key", "w"]), targets, rng.choice(["inner", "left", "right", "outer"]), drop_source=rng.random() < 0.5) for _ in range(rng.choice([0, 1]))]
        spec_ = TableSpec(
            FileSpec("x.csv"), names, lookups=looks, fill=() if looks else rng.choice([(), (FillSpec("subject_id", "other"),), (FillSpec("code", "other"),)]), pad={} if looks else rng.choice([{}, {"subject_id": {"suffix": ":s"}}]),
            melt=rng.choice([(), (MeltSpec({"timestamp": "T/"}),)]), code_prefix=rng.choice([None, "P/"]), dedupe=rng.random() < 0.5,
        )
        early, late = (compile_table(spark, spec_, ids, raw=df, sides={"side.csv": side}, early=e) for e in (True, False))
        assert early.columns == late.columns and rows(early) == rows(late), spec_
        seen.add(early_subjects(spec_))
    assert seen == {True, False}


def test_reader_options_of_a_description(spark, tmp_path):
    (tmp_path / "notes.csv").write_text("id;note;n\n1;'two\nlines; ''quotes'' end';NA\n2;plain;5\n", encoding="ISO-8859-1")
    file = FileSpec(str(tmp_path / "notes.csv"), sep=";", encoding="ISO-8859-1", quote="'", escape="'", multi_line=True, null_words=("NA", "null"))
    got = compile_table(spark, TableSpec(file, {"id": "id", "note": "note", "n": "n"}))
    assert rows(got) == [("1", "two\nlines; 'quotes' end", None), ("2", "plain", "5")]


def test_nested_descriptions_from_plain_dicts():
    given = {
        "patients": {"path": "p.csv", "sep": "|"}, "patients_rename": {"CPR": "subject_id"},
        "tables": {"t": {"file": {"path": "t.csv", "null_words": ["NA"]}, "rename": {"a": "code"}, "lookups": [{"file": {"path": "l.csv"}, "on": "code", "key": "k", "targets": {"x": "y"}}], "pad": {"code": {"suffix": "!"}}, "melt": [{"columns": {"a": "A/"}}], "on_bad_time": "fail"}},
        "events": {"t": {"e": {"code": ["T", "col(code)"], "time": "col(timestamp)"}}},
    }
    built = from_dict(PipelineSpec, given)
    table = TableSpec(FileSpec("t.csv", null_words=("NA",)), {"a": "code"}, lookups=(LookupSpec(FileSpec("l.csv"), "code", "k", {"x": "y"}),), pad={"code": {"suffix": "!"}}, melt=(MeltSpec({"a": "A/"}),), on_bad_time="fail")
    assert built == PipelineSpec(FileSpec("p.csv", sep="|"), {"CPR": "subject_id"}, {"t": table}, {"t": {"e": EventSpec(("T", "col(code)"), "col(timestamp)")}})
    with pytest.raises(SpecError, match="colour"):
        from_dict(PipelineSpec, {**given, "tables": {"t": {"file": {"path": "x", "colour": 1}, "rename": {}}}})


def test_bad_times_can_fail(spark):
    df = spark.createDataFrame([("1", "2021-01-02"), ("2", None)], "s string, t string")
    names = {"s": "code", "t": "timestamp"}
    assert compile_table(spark, TableSpec(FileSpec("x"), names, on_bad_time="fail"), raw=df).count() == 2
    bad = df.union(spark.createDataFrame([("3", "soon")], df.schema))
    assert compile_table(spark, TableSpec(FileSpec("x"), names), raw=bad).filter("timestamp is null").count() == 2
    with pytest.raises(Exception, match="soon"):
        compile_table(spark, TableSpec(FileSpec("x"), names, on_bad_time="fail"), raw=bad).collect()


def test_format_drift_is_noticed():
    table = TableSpec(FileSpec("t.csv"), {"a": "code", "t": "timestamp"})
    drifts = lambda *formats: lint(PipelineSpec(FileSpec("p.csv"), {}, {"t": table}, {"t": {"e": EventSpec("col(code)", "col(timestamp)", formats)}}))
    assert len(drifts("%Y-%m-%d %H:%M:%S")) == 1 and not drifts() and not drifts("%Y-%m-%d %H:%M:%S.%f")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from eventloom.work import shared_folder

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://h:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(session)


def test_lint(raw):
    patients, contacts, diagnoses, stays = raw
    bad = TableSpec(diagnoses, {"code": "code", "w": "w"}, strip_zeros=("w",), value_maps={"w": {"01": "x"}}, code_prefix="A/", unroll={"code": "A/"}, lookups=(LookupSpec(contacts, "a", "b", {"c": "c"}), LookupSpec(contacts, "a", "b", {"d": "d"})), combine_lookups=False)
    warnings = lint(PipelineSpec(patients, {}, {"t": bad}, {"u": {}, "t": {"e": EventSpec(["A", "col(code)"])}}))
    assert len(warnings) == 5
    with pytest.raises(SpecError, match="test_rows"):
        from_dict(TableSpec, {"file": diagnoses, "rename": {}, "test_rows": 3})


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "ø"), (2, None)], "i int, s string")
    assert save(df, str(tmp_path / "a.asc"), "csv", sep="|", encoding="ISO-8859-1") == 2
    assert save(df, str(tmp_path / "a.asc"), "csv", mode="append", sep="|", encoding="ISO-8859-1") == 2
    back = read_table(spark, str(tmp_path / "a.asc"), ["s", "i"], sep="|", encoding="ISO-8859-1")
    assert back.dtypes == [("s", "string"), ("i", "string")] and back.count() == 4
    df.coalesce(1).write.options(header=True, compression="gzip").csv(str(tmp_path / "b.csv"))
    assert read_table(spark, str(tmp_path / "b.csv")).count() == 2
    assert save(df.limit(0), str(tmp_path / "c"), skip_empty=True) is None and not (tmp_path / "c").exists()
    assert save(df.limit(0), str(tmp_path / "c")) == 0 and spark.read.parquet(str(tmp_path / "c")).columns == ["i", "s"]
    with pytest.raises(SpecError, match="format"):
        read_table(spark, "x.xlsx")


def test_ingest_reads_each_file_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / x) for x in ("landing", "out", "state"))
    df = spark.createDataFrame([(1, DAY), (1, DAY), (2, DAY)], "k int, t timestamp_ntz").withColumn("t", F.col("t").cast("timestamp"))
    for _ in range(2):
        df.write.mode("append").parquet(landing)
        ingest(spark, landing, df.schema, lambda b: b.withColumn("x", F.lit(1)), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 6
    ingest(spark, landing, df.schema, lambda b: b, out + "2", state + "2", event_time="t", keys=["k"]).awaitTermination()
    assert spark.read.parquet(out + "2").select("k").distinct().count() == spark.read.parquet(out + "2").count() == 2


@pytest.mark.skipif(not SF.exists(), reason="the test tables are absent")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    df = queries.QUERIES[name](spark, str(SF))
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = [tuple(r[names.index(c)] for c in df.columns) for r in result.fetchall()]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(expected, key=key)
