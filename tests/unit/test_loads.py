"""What lives over several loads: ids, cohorts, ingested files, statistics; and what each stage of a plan loses."""

import datetime as dt
import random
import uuid
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventloom.errors import ConcurrentLoad, SpecError
from eventloom.functions.columns import strip_zeros
from eventloom.operators import cohort, labs, layout, lookups
from eventloom.operators.layout import manifest_path, merge_cohort, read_manifest, write_cohort
from eventloom.operators.subjects import extend_id_map, read_id_map
from eventloom.plans.config import NULL_WORDS, dataset_options, pipeline_from, read_config, run_config
from eventloom.plans.run import build_dataset, run_pipeline, shared_sides, stage_table
from eventloom.plans.spec import EventSpec, FileSpec, LookupSpec, PipelineSpec, TableSpec
from eventloom.plans.tables import combined, compile_table, dropping, early_subjects, subject_finder
from eventloom.streaming.ingest import ingest, ingest_table
from eventloom.work import materialised

DAY = dt.datetime(2021, 1, 2)


def test_long_ids_keep_every_digit(spark):
    texts = ["9007199254740993", "0123456789012345678", "+007", "-005", " 12.000 ", "12.", "1e3", "1.5", "x", None, "99999999999999999999", "-0", ".0", "1.0f"]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strip_zeros(F.col("t")).alias("v")).collect()]
    assert got == ["9007199254740993", "123456789012345678", "7", "-5", "12", "12", "1000", None, None, None, None, "0", "0", None]
    number = spark.createDataFrame([(9007199254740993, 3.0)], "a long, b double").select(strip_zeros(F.col("a")), strip_zeros(F.col("b")))
    assert tuple(number.first()) == ("9007199254740993", "3")


# --- lookups


FILES = [FileSpec("one.csv"), FileSpec("two.csv")]


def random_lookups(rng):
    names = ["x", "y", "z"]
    out = []
    for _ in range(rng.randrange(2, 5)):
        columns = rng.sample(["p", "q", "r"], rng.choice([1, 1, 2]))
        targets = dict(zip(columns, rng.sample([*names, "a", "b", "c"], len(columns)), strict=True))
        out.append(LookupSpec(FILES[rng.random() < 0.3], "xy"[rng.random() < 0.2], "key", targets, rng.choice(["inner", "left", "left", "left"]), drop_source=rng.random() < 0.3))
    return out


def test_combined_lookups_are_chained_ones(spark):
    rng = random.Random(6)
    keys = ["k1", "k2", "k3", None]
    df = spark.createDataFrame([tuple(rng.choice(keys) for _ in range(3)) + (i,) for i in range(25)], "x string, y string, z string, i int")
    # keys are unique, and what lookups bring is a key of other lookups
    sides = {f.path: spark.createDataFrame([(k, *(rng.choice(keys) for _ in range(3))) for k in rng.sample(keys[:3], 2 + n)], "key string, p string, q string, r string").cache() for n, f in enumerate(FILES)}
    joined = 0
    for i in range(22):
        looks = random_lookups(rng)
        while i % 2 and len(combined(looks)) == len(looks):  # every second list has lookups to combine
            looks = random_lookups(rng)
        results = []
        for combine in (True, False):
            spec = TableSpec(FileSpec("t.csv"), {c: c for c in df.columns}, lookups=looks, combine_lookups=combine, dedupe=False, times=())
            try:
                out = compile_table(spark, spec, raw=df, sides=sides)
                results.append((sorted(out.columns), rows(out.select(*sorted(out.columns)))))
            except ValueError as error:
                results.append(type(error))
        assert results[0] == results[1], looks
        joined += len(combined(looks)) < len(looks)
    assert joined >= 11


def test_the_key_goes_after_its_last_use():
    one, two = FILES
    by = lambda file, on, to, drop=False: LookupSpec(file, on, "key", {"p": to}, drop_source=drop)
    assert dropping([by(one, "x", "a"), by(two, "x", "b"), by(one, "x", "c", True)]) == [False, False, True]
    assert dropping([by(one, "x", "a", True), by(two, "x", "b")]) == [False, True]
    assert dropping([by(one, "x", "a", True), by(two, "y", "x"), by(one, "x", "b")]) == [True, False, False]
    apart = [LookupSpec(one, "x", "key", {"p": "a"}), by(two, "a", "b"), LookupSpec(one, "x", "key", {"q": "c"}, drop_source=True)]
    assert [(set(o.targets.values()), o.drop_source) for o in combined(apart)] == [({"a", "c"}, True), ({"b"}, False)]
    for between in (by(two, "y", "x"), by(two, "c", "d"), by(two, "y", "c"), LookupSpec(two, "y", "key", {"p": "b"}, "right")):
        assert len(combined([apart[0], between, apart[2]])) == 3
    assert len(combined([by(one, "x", "a"), by(one, "x", "b")])) == 2  # the same column twice


def test_no_early_ids_where_bad_times_fail(spark):
    spec = TableSpec(FileSpec("x"), {"s": "subject_id", "c": "code", "t": "timestamp"}, on_bad_time="fail")
    assert not early_subjects(spec)
    df = spark.createDataFrame([("unknown", "c", "soon")], "s string, c string, t string")
    ids = spark.createDataFrame([("p", 2)], "source_id string, subject_id long")
    assert compile_table(spark, TableSpec(spec.file, spec.rename), ids, raw=df).collect() == []


# --- splits and statistics


def test_a_subject_has_one_split(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("subject_id"))
    twice = spark.createDataFrame([(5, "train"), (5, "train"), (6, "tuning"), (None, "train"), (7, None)], "subject_id long, split string")
    got = {r.subject_id: r.split for r in cohort.split_subjects(df, override=twice).collect()}
    assert len(got) == 20 and (got[5], got[6]) == ("train", "tuning")
    with pytest.raises(Exception, match="subject 5 is in splits train and tuning"):
        cohort.split_subjects(df, override=twice.union(spark.createDataFrame([(5, "tuning")], twice.schema))).collect()
    (tmp_path / "s.json").write_text('{"train": [1, 2], "held_out": [2]}')
    with pytest.raises(Exception, match="subject 2 is in splits"):
        cohort.read_splits(spark, str(tmp_path / "s.json")).collect()


def test_statistics_name_their_method(spark, tmp_path):
    df = spark.createDataFrame([("A", float(i)) for i in range(100)], "code string, numeric_value double")
    path = str(tmp_path / "stats")
    labs.normalise(df, "minmax", statistics=path)
    with pytest.raises(SpecError, match="those of minmax"):
        labs.normalise(df, "quantile", 2, statistics=path)
    labs.normalise(df.limit(0), "quantile", 4, statistics=path + "4")
    with pytest.raises(SpecError, match="quantile"):
        labs.normalise(df, "quantile", 2, statistics=path + "4")
    assert {r.value_label for r in labs.normalise(df, "quantile", 4, statistics=path + "4").collect()} == {"N/A"}
    labs.fit(df).write.parquet(path + "5")
    with pytest.raises(SpecError, match="unknown"):
        labs.normalise(df, statistics=path + "5")


def test_salted_lookups(spark):
    rng = random.Random(8)
    data = [(i, None if rng.random() < 0.6 else "hot" if rng.random() < 0.5 else f"k{rng.randrange(300)}") for i in range(6000)]
    df = spark.createDataFrame(data, "i int, k string")
    side = spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [("hot", -1), ("hot", -2), (None, -3)], "key string, v int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for how in ("inner", "left"):
            plain, salted = (lookups.lookup(df, side, "k", "key", {"v": "v"}, how, salts=n) for n in (0, 16))
            assert plain.columns == salted.columns and rows(plain) == rows(salted)
        sizes = sorted(r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] < 3 * sizes[4]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == threshold
    for bad in ({"how": "right"}, {"null_keys_match": True}):
        with pytest.raises(ValueError, match="salted"):
            lookups.lookup(df, side, "k", "key", {"v": "v"}, salts=4, **bad)
    assert lookups.lookup(df.limit(0), side, "k", "key", {"v": "v"}, salts=4).count() == 0


def test_lookups_meet_known_subjects_only_where_rows_stay_the_same(spark):
    rng, seen = random.Random(9), set()
    df = spark.createDataFrame([(rng.choice(["c1", "c2", "c3", None]), rng.choice(["p1", "p9"]), rng.choice(["A", None]), "2021-01-02") for _ in range(30)], "c string, s string, k string, t string")
    side = spark.createDataFrame([("c1", "p1", "c2"), ("c2", "p2", "c1"), ("c2", "p9", "c3"), ("c3", None, "c1"), ("p1", "p2", "c1")], "key string, p string, q string")
    ids = spark.createDataFrame([("p1", 2), ("p2", 3), ("p2!", 4)], "source_id string, subject_id long")
    for _ in range(14):
        find = LookupSpec(FILES[0], rng.choice(["c", "c", "subject_id"]), "key", {"p": "subject_id"}, rng.choice(["inner", "inner", "left", "right"]), dedupe=rng.random() < 0.2)
        more = rng.choice([(), (LookupSpec(FILES[0], rng.choice(["c", "subject_id"]), "key", {"q": "q"}, rng.choice(["inner", "left", "right"])),)])
        spec = TableSpec(FileSpec("t"), {"c": "c", "s": "subject_id", "k": "code", "t": "timestamp"}, lookups=(find, *more), pad=rng.choice([{}, {}, {"subject_id": {"suffix": "!"}}]), dedupe=False)
        early, late = (compile_table(spark, spec, ids, raw=df, sides={FILES[0].path: side}, early=e) for e in (True, False))
        assert early.columns == late.columns and rows(early) == rows(late), spec
        seen.add(subject_finder(spec, spec.lookups))
    assert {None, 0} <= seen


def test_states_and_sketches_add_up(spark):
    df = spark.range(5000).selectExpr("concat('c', id % 3) as code", "cast(if(id % 5 = 0, null, id) as double) as numeric_value", "id % 800 + 2 as subject_id", "cast(null as timestamp_ntz) as time")
    parts = [df.filter("numeric_value < 1000"), df.filter("not coalesce(numeric_value < 1000, false)"), df.limit(0)]
    merged = cohort.metadata_of_states(cohort.merged_states(*map(cohort.code_states, parts)))
    assert rows(merged) == rows(cohort.code_metadata(df).select(merged.columns))
    far = spark.createDataFrame([(2**40, "x", 1.0), (2, "x", None), (2, "x", None)], "subject_id long, code string, numeric_value double")
    assert cohort.metadata_of_states(cohort.code_states(far)).select("n_events", "n_subjects", "n_values").first() == (3, 2, 1)
    cuts = labs.fit_sketches(labs.merged_sketches(*map(labs.sketches, parts)), "category").collect()
    for r in cuts:
        all_ = sorted(x.numeric_value for x in df.filter(f"code = '{r.code}' and numeric_value is not null").collect())
        assert r.n_values == len(all_)
        assert all(abs(sum(v <= c for v in all_) / len(all_) - p) < 0.006 for c, p in zip(r.cuts, (0.25, 0.5, 0.75), strict=True))


# --- configurations


def test_configurations(spark, tmp_path):
    (tmp_path / "contacts.csv").write_text("cid|who|ended|clock\nc1|p1|2021-01-02|10:00:00\nc2|NA|2021-01-03|11:00:00\n", encoding="latin1")
    (tmp_path / "diag.csv").write_text("cid|kode|art\nc1|D1|A\nc2|D2|B\n", encoding="latin1")
    (tmp_path / "adm.csv").write_text("Køn,ind,ud,ward,spec\np1,2021-01-02,2021-01-05 12:00,W,01\n", encoding="utf-8")
    (tmp_path / "people.csv").write_text("id,født\np1,1980-01-01\n", encoding="utf-8")
    source = """
paths: {root: "${oc.env:ROOT}", raw: "${paths.root}", output: "${paths.root}/${oc.env:OUT,out}"}
logging: {level: INFO}
write_file_type: parquet
test: true
chunksize: 10
align_timestamps: {names: [timestamp], format: "%Y-%m-%d %H:%M:%S"}
tables:
  diag:
    filename: ${paths.raw}/diag.csv
    file_info: {sep: "|", encoding: latin1}
    rename_columns: {cid: contact, kode: code, art: kind}
    code_prefix: D/
    unroll_columns: [{column: kind, prefix: K/}, {column: code, prefix: D2/}]
    mappings:
      - {source_column: contact, via_file: "${paths.raw}/contacts.parquet", join_on: cid, target_column: who, rename_to: subject_id}
      - {source_column: contact, via_file: "${paths.raw}/contacts.parquet", join_on: cid, target_column: ended, rename_to: day}
      - {source_column: contact, via_file: "${paths.raw}/contacts.parquet", join_on: cid, target_column: clock, rename_to: clock, drop_source: true}
    combine_datetime: {timestamp: {date_col: day, time_col: clock, drop_original: true}}
  adm:
    filename: ${paths.raw}/adm.csv
    rename_columns: {Køn: subject_id, ind: t_in, ud: t_out, ward: code, spec: spec}
    normalize_columns: [spec]
    value_map: {spec: {1: surgery}}
    pad_values: {t_in: {suffix: " 00:00:00", unless_contains: ":"}}
    melt_table: [{target_name: timestamp, source_cols: [t_in, t_out], prefix_col: code, prefix_map: {t_in: IN/, t_out: OUT/}}]
    fillna: {code: {value: none}}
patients_info:
  filename: ${paths.raw}/people.csv
  rename_columns: {id: subject_id, født: birthdate}
"""
    (tmp_path / "c.yaml").write_text(source, encoding="utf-8")
    config, env = read_config(str(tmp_path / "c.yaml")), {"ROOT": str(tmp_path)}
    spark.read.options(header=True, sep="|").csv(str(tmp_path / "contacts.csv")).write.parquet(str(tmp_path / "contacts.parquet"))
    reports = {r.table: r for r in run_config(spark, config, env=env)}
    assert {k: (r.status, r.rows) for k, r in reports.items()} == {"subject": ("written", 1), "diag": ("written", 2), "adm": ("written", 1)}
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert rows(read("diag").select("subject_id", "code", "timestamp")) == [(2, "D2/D/D1", dt.datetime(2021, 1, 2, 10)), (2, "K/A", dt.datetime(2021, 1, 2, 10))]
    assert rows(read("adm").select("code", "spec", "timestamp")) == [("IN/W", "surgery", DAY)]  # the other time has another form
    assert pipeline_from(config, env=env).tables["diag"].file == FileSpec(f"{tmp_path}/diag.csv", sep="|", encoding="ISO-8859-1", null_words=NULL_WORDS)
    for change, message in (({"tables": {"x": {**config["tables"]["adm"], "renam": {}}}}, "renam"), ({"paths": {}}, "has no value"), ({"paths": {"raw": "${paths.raw}"}}, "has no value")):
        with pytest.raises(SpecError, match=message):
            pipeline_from({**config, **change}, env=env)
    with pytest.raises(SpecError, match="ROOT"):
        pipeline_from(config, env={})
    events = {"subject_id_col": "subject_id", "subject": {"subject_id_col": "pid", "dob": {"code": ["DOB"], "time": "col(birthdate)", "time_format": "%Y-%m-%d"}, "g": {"code": ["G", "col(g)"], "time": None}}, "diag": {"d": {"code": "col(code)", "time": "col(timestamp)", "numeric_value": "col(v)"}}}
    spec = pipeline_from(config, events, env)
    assert spec.events["subject"] == {"dob": EventSpec(("DOB",), "col(birthdate)", ("%Y-%m-%d",)), "g": EventSpec(("G", "col(g)"))}
    assert spec.events["diag"] == {"d": EventSpec("col(code)", "col(timestamp)", (), "col(v)")} and spec.subject_columns == {"subject": "pid", "diag": "subject_id"}
    assert dataset_options({"etl_metadata": {"dataset_name": "n", "dataset_version": 2.0}, "stage_configs": {"split_and_shard_subjects": {"split_fracs": {"train": 1.0}}}}) == {"splits": {"train": 1.0}, "name": "n", "version": "2.0"}


# --- ids


def test_ids_keep_their_numbers(spark, tmp_path):
    path, make = str(tmp_path / "ids"), lambda *ids: spark.createDataFrame([(i,) for i in ids], "who string")
    assert read_id_map(spark, path) is None
    rng, known, names = random.Random(1), {}, [f"p{i}" for i in range(60)]
    for load in range(5):
        some = rng.sample(names, 10 * load + 3) + [None]
        got = {r.source_id: r.subject_id for r in extend_id_map(make(*some, *some), "who", path).collect()}
        new = sorted({*some} - known.keys() - {None})
        assert got == known | {n: len(known) + 2 + i for i, n in enumerate(new)}
        known = got
    versions = {r.version for r in read_id_map(spark, path).collect()}
    extend_id_map(make("p1", None), "who", path)
    assert {r.version for r in read_id_map(spark, path).collect()} == versions
    assert extend_id_map(make(), "who", str(tmp_path / "none")).count() == 0


def test_two_loads_at_once_are_noticed(spark, tmp_path):
    path, make = str(tmp_path / "ids"), lambda *ids: spark.createDataFrame([(i,) for i in ids], "who string")
    extend_id_map(make("a"), "who", path)
    (tmp_path / "ids" / "version=2").mkdir()
    with pytest.raises(ConcurrentLoad, match="version=2"):
        extend_id_map(make("b"), "who", path)
    (tmp_path / "ids" / "version=2").rmdir()
    assert rows(extend_id_map(make("b"), "who", path).select("source_id", "subject_id")) == [("a", 2), ("b", 3)]


# --- cohort


def some_events(spark, n=6000, people=300):
    return spark.range(n).selectExpr(f"pow(id, 2) % {people} + 2 as subject_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, int(id % 50)) as time", "concat('c', id % 7) as code", "cast(id as float) as numeric_value").withColumn("subject_id", F.col("subject_id").cast("bigint"))


def files(path):
    return {str(p.parent): p for p in Path(path).rglob("*.parquet")}


def test_files_by_size(spark, tmp_path):
    events, path = spark.range(20_000).selectExpr("id % 997 + 2 as subject_id", "cast(null as timestamp_ntz) as time", "'c' as code", "cast(id as float) as numeric_value"), str(tmp_path / "c")
    write_cohort(events, cohort.split_subjects(events), path, rows_per_file=1000)
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    sizes = {(r.split, r.shard): r["count"] for r in back.groupBy("split", "shard", "f").count().collect()}
    assert len(sizes) == len(files(path)) == back.select("f").distinct().count()  # one file a shard
    assert max(sizes.values()) <= 2 * min(sizes.values()) and max(sizes.values()) <= 1000 + 21
    assert back.select("subject_id", "f").distinct().count() == 997 and back.count() == 20_000
    assert {(r.split, r.shard): r.n for r in read_manifest(spark, path).groupBy("split", "shard").agg(F.sum("n").alias("n")).collect()} == sizes
    empty = str(tmp_path / "e")
    write_cohort(events.limit(0), cohort.split_subjects(events), empty)
    assert not files(empty) and read_manifest(spark, empty).count() == 0
    with pytest.raises(ValueError, match="whole"):
        merge_cohort(events, cohort.split_subjects(events), empty)
    write_cohort(events.limit(10), cohort.split_subjects(events), path)
    assert spark.read.parquet(path).count() == 10


def test_a_subject_with_most_events_stays_whole(spark, tmp_path):
    events = spark.range(9000).selectExpr("if(id % 3 = 0, 5, id % 500) as subject_id", "cast(null as timestamp_ntz) as time", "'c' as code", "cast(id as float) as numeric_value")
    path = str(tmp_path / "c")
    write_cohort(events, spark.range(501).selectExpr("id as subject_id", "'all' as split"), path, rows_per_file=500)
    back = spark.read.parquet(path)
    assert back.count() == 9000 and back.select("subject_id", "shard").distinct().count() == 500
    shards = sorted(r.shard for r in back.select("shard").distinct().collect())
    assert shards == list(range(len(shards)))


def test_merged_batches_are_one_load(spark, tmp_path):
    events, path = some_events(spark), str(tmp_path / "c")
    people = spark.range(1000).select((F.col("id") + 2).alias("subject_id"))
    splits = cohort.split_subjects(people)
    first = events.filter("subject_id < 200 and numeric_value % 3 < 2")
    write_cohort(first, splits, path, rows_per_file=400)
    before = {f: p.stat().st_mtime_ns for f, p in files(path).items()}
    few = events.filter("subject_id between 20 and 22")
    changed = merge_cohort(few, splits, path)
    after = {f: p.stat().st_mtime_ns for f, p in files(path).items()}
    assert changed == sum(before[f] != after[f] for f in before) + len(after.keys() - before.keys()) < len(after)
    for _ in range(2):  # a batch that is merged again changes nothing
        merge_cohort(events, splits, path)
        back = spark.read.parquet(path)
        expected = events.dropDuplicates().join(splits, "subject_id")
        assert Counter(map(tuple, back.select("subject_id", "time", "code", "numeric_value", "split").collect())) == Counter(map(tuple, expected.select("subject_id", "time", "code", "numeric_value", "split").collect()))
        assert back.select("subject_id", "split", "shard").distinct().count() == back.select("subject_id").distinct().count()
    for p in files(path).values():
        found = [(r.subject_id, r.time, r.code) for r in spark.read.parquet(str(p)).collect()]
        assert found == sorted(found)
    sizes = {(r.split, r.shard): r["count"] for r in back.groupBy("split", "shard").count().collect()}
    assert sizes == {(r.split, r.shard): r.n for r in read_manifest(spark, path).groupBy("split", "shard").agg(F.sum("n").alias("n")).collect()}
    assert Path(manifest_path(path)).exists()


# --- stages of a plan


def clinic(spark, folder, people):
    spark.createDataFrame([(p,) for p in people], "id string").write.mode("overwrite").parquet(f"{folder}/people")
    contacts = [("c1", "p1"), ("c2", "p2"), ("c3", "p9"), ("c4", None)]
    spark.createDataFrame(contacts, "contact string, person string").write.mode("overwrite").parquet(f"{folder}/contacts")
    labs_ = [("c1", "A", "2021-01-02"), ("c1", "A", "2021-01-02"), ("c2", None, "2021-01-02"), ("c3", "B", "2021-01-02"), ("c8", "B", "2021-01-02"), ("c2", "C", "bad")]
    spark.createDataFrame(labs_, "contact string, code string, t string").write.mode("overwrite").parquet(f"{folder}/labs")
    table = TableSpec(FileSpec(f"{folder}/labs", "parquet"), {"contact": "contact", "code": "code", "t": "timestamp"}, lookups=(LookupSpec(FileSpec(f"{folder}/contacts", "parquet"), "contact", "contact", {"person": "subject_id"}),))
    return PipelineSpec(FileSpec(f"{folder}/people", "parquet"), {"id": "subject_id"}, {"labs": table}, {"labs": {"lab": EventSpec("col(code)", "col(timestamp)")}})


def test_rows_of_each_stage(spark, tmp_path):
    reports = run_pipeline(spark, clinic(spark, tmp_path, ["p1", "p2"]), str(tmp_path / "out"))
    assert dict(reports[1].stages) == {"read": 6, "lookups": 5, "known": 4, "complete": 2, "distinct": 1}
    assert [(r.stage, r.lost) for r in stage_table(spark, reports).orderBy("place").collect()] == [("read", None), ("lookups", 1), ("known", 1), ("complete", 2), ("distinct", 1)]
    # nobody is known, so execution may leave stages out
    reports = run_pipeline(spark, clinic(spark, tmp_path, []), str(tmp_path / "none"))
    assert reports[1].status == "written" and reports[1].rows == 0 and dict(reports[1].stages)["distinct"] in (0, None)
    reports = run_pipeline(spark, clinic(spark, tmp_path, []), str(tmp_path / "skip"), skip_empty=True)
    assert reports[1].status == "empty" and not (tmp_path / "skip" / "labs").exists()
    assert run_pipeline(spark, clinic(spark, tmp_path, ["p1"]), str(tmp_path / "quiet"), count_stages=False)[1].stages == ()


def test_a_run_goes_on_where_another_ended(spark, tmp_path):
    spec, out = clinic(spark, tmp_path, ["p1", "p2"]), str(tmp_path / "out")
    more = replace(spec, tables={**spec.tables, "again": spec.tables["labs"], "broken": replace(spec.tables["labs"], file=FileSpec(f"{tmp_path}/later", "parquet"))})
    first = run_pipeline(spark, more, out, at_once=3)
    assert [(r.table, r.status) for r in first] == [("subject", "written"), ("labs", "written"), ("again", "written"), ("broken", "failed")]
    written = {f: p.stat().st_mtime_ns for f, p in files(out).items() if "reports" not in f}
    spark.read.parquet(f"{tmp_path}/labs").write.parquet(f"{tmp_path}/later")
    second = run_pipeline(spark, more, out, resume=True)
    assert second[:3] == first[:3] and second[3].rows == first[1].rows
    now = {f: p.stat().st_mtime_ns for f, p in files(out).items()}
    assert all(now[f] == t for f, t in written.items()) and f"{out}/broken" in now
    changed = replace(more, tables={"labs": replace(spec.tables["labs"], code_prefix="L/")})
    assert run_pipeline(spark, changed, out, resume=True)[1].rows == first[1].rows
    assert [r.code for r in spark.read.parquet(f"{out}/labs").collect()] == ["L/A"]
    with pytest.raises(SpecError, match="resumed"):
        run_pipeline(spark, spec, out, mode="append", resume=True, id_map=f"{out}/ids")


def test_runs_share_a_map_of_ids(spark, tmp_path):
    ids = str(tmp_path / "ids")
    run_pipeline(spark, clinic(spark, tmp_path, ["p2"]), str(tmp_path / "out"), id_map=ids)
    run_pipeline(spark, clinic(spark, tmp_path, ["p1", "p2"]), str(tmp_path / "out"), mode="append", id_map=ids)
    got = spark.read.parquet(str(tmp_path / "out" / "subject"))
    assert sorted(r.subject_id for r in got.collect()) == [2, 2, 3]
    with pytest.raises(SpecError, match="id_map"):
        run_pipeline(spark, clinic(spark, tmp_path, ["p1"]), str(tmp_path / "out"), mode="append")
    build_dataset(spark, clinic(spark, tmp_path, ["p1", "p2"]), str(tmp_path / "set"), id_map=ids)
    assert {r.subject_id for r in spark.read.parquet(str(tmp_path / "set" / "data")).collect()} == {3}


# --- ingest


def test_repeats_across_batches(spark, tmp_path):
    landing, out, state = (str(tmp_path / x) for x in ("landing", "out", "state"))
    schema = "who string, what string, at timestamp_ntz"
    land = lambda *data: spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landing)
    spec = TableSpec(FileSpec(landing, "parquet"), {"who": "subject_id", "what": "code", "at": "timestamp"})
    later = DAY + dt.timedelta(days=400)
    land(("1", "a", DAY), ("1", "a", DAY), ("2", "b", later))
    types = spark.read.parquet(landing).schema
    ids = spark.createDataFrame([("1", 2), ("2", 3)], "source_id string, subject_id long")
    ingest_table(spark, spec, types, out, state, ids, day_of="timestamp").awaitTermination()
    land(("1", "a", DAY), ("2", "b", later), ("2", "c", later), ("9", "x", DAY), ("1", None, DAY))
    ingest_table(spark, spec, types, out, state, ids, day_of="timestamp").awaitTermination()
    back = spark.read.parquet(out)
    assert rows(back.select("subject_id", "code", "timestamp")) == [(2, "a", DAY), (3, "b", later), (3, "c", later)]
    assert rows(back.select("batch", "day")) == [(0, DAY.date()), (0, later.date()), (1, later.date())]


def test_a_batch_after_a_failure_replaces_itself(spark, tmp_path):
    landing, out, state = (str(tmp_path / x) for x in ("landing", "out", "state"))
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "n")], "k int, v string")
    df.coalesce(1).write.parquet(landing)
    failing = [True]

    def transform(batch):
        if failing[0]:
            # the batch has been written when its pass fails
            batch.dropDuplicates(["k"]).write.mode("overwrite").parquet(f"{out}/batch=0")
            raise RuntimeError("lost")
        return batch

    with pytest.raises(Exception, match="lost"):
        ingest(spark, landing, df.schema, transform, out, state, distinct_on=["k"]).awaitTermination()
    failing[0] = False
    for _ in range(2):
        ingest(spark, landing, df.schema, transform, out, state, distinct_on=["k"]).awaitTermination()
    assert rows(spark.read.parquet(out).select("k", "v")) == [(1, "a"), (2, None), (None, "n")] or rows(spark.read.parquet(out).select("k", "v")) == [(None, "n"), (1, "a"), (2, None)]
    df.coalesce(1).write.mode("append").parquet(landing)
    ingest(spark, landing, df.schema, transform, out, state, distinct_on=["k"]).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(ValueError, match="day_of"):
        ingest(spark, landing, df.schema, transform, out, state, distinct_on=["k"], day_of="v")


def test_intermediate_tables_are_emptied(spark, tmp_path):
    from eventloom.work import cleared, materialised

    with cleared(spark):
        a = materialised(spark.range(10))
        with cleared(spark):
            b = materialised(spark.range(20))
            assert b.count() == 20
        again = spark.read.parquet(b.inputFiles()[0].rpartition("/")[0]) if b.inputFiles() else None
        assert a.count() == 10 and (again is None or again.count() == 0)
        place = a.inputFiles()[0].rpartition("/")[0]
    assert spark.read.parquet(place).count() == 0
    kept = materialised(spark.range(5))
    events = some_events(spark, 500)
    write_cohort(events, cohort.split_subjects(events), str(tmp_path / "c"))
    assert kept.count() == 5 and spark.read.parquet(str(tmp_path / "c")).count() == 500


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", "NaN"), ("A", " nan"), ("A", "low")], "code string, numeric_value string")
    got = [(r.numeric_value, r.value_label) for r in labs.normalise(df).collect()]
    assert got[2:] == [(None, None), (None, None), (None, "low")]


def test_side_files_of_several_tables_are_read_once(spark, tmp_path):
    (tmp_path / "side.csv").write_text("key;a;b;unused\nk1;1;x;0\nk2;2;y;0\n")
    (tmp_path / "own.csv").write_text("key,a\nk1,7\n")
    (tmp_path / "t.csv").write_text("k,code\nk1,A\nk2,B\nk3,C\n")
    side, own = FileSpec(f"{tmp_path}/side.csv", sep=";"), FileSpec(f"{tmp_path}/own.csv")
    table = lambda *looks: TableSpec(FileSpec(f"{tmp_path}/t.csv"), {"k": "k", "code": "code"}, lookups=looks)
    tables = {
        "one": table(LookupSpec(side, "k", "key", {"a": "va"})), "two": table(LookupSpec(side, "k", "key", {"b": "vb"}), LookupSpec(own, "k", "key", {"a": "o"}, "left")),
        "bad": table(LookupSpec(side, "k", "key", {"absent": "v"})), "gone": table(LookupSpec(FileSpec(f"{tmp_path}/gone.csv"), "k", "key", {"a": "v"})), "gone2": table(LookupSpec(FileSpec(f"{tmp_path}/gone.csv"), "k", "key", {"a": "v"})),
    }
    sides = shared_sides(spark, tables)
    assert list(sides) == [side.path] and sorted(sides[side.path].columns) == ["a", "b", "key"]
    (tmp_path / "people.csv").write_text("id\np1\n")
    reports = run_pipeline(spark, PipelineSpec(FileSpec(f"{tmp_path}/people.csv"), {"id": "subject_id"}, tables), str(tmp_path / "out"), at_once=2)
    assert {r.table: (r.status, r.rows) for r in reports} == {"subject": ("written", 1), "one": ("written", 2), "two": ("written", 2), "bad": ("failed", None), "gone": ("failed", None), "gone2": ("failed", None)}
    assert rows(spark.read.parquet(f"{tmp_path}/out/two").select("code", "vb", "o")) == [("A", "x", "7"), ("B", "y", None)]


# --- tasks that grow with the events


def tasks_of(spark, action):
    """Tasks of each stage that ``action`` runs."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "")
    action()
    stages = [stage for job in sc.statusTracker().getJobIdsForGroup(group) for stage in sc.statusTracker().getJobInfo(job).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    return [info.numTasks for info in map(sc.statusTracker().getStageInfo, stages) if info and info.numCompletedTasks]


def test_tasks_follow_events_not_files(spark, tmp_path):
    """many small files are written by few tasks, each subject in one file."""
    events, path = spark.range(6000).selectExpr("id % 300 + 2 as subject_id", "cast(null as timestamp_ntz) as time", "'c' as code", "cast(id as float) as numeric_value"), str(tmp_path / "c")
    splits = materialised(cohort.split_subjects(events))
    assert max(tasks_of(spark, lambda: write_cohort(events, splits, path, rows_per_file=100))) <= spark.sparkContext.defaultParallelism
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    assert max(tasks_of(spark, lambda: layout.read_cohort(spark, path).count())) <= 4 * spark.sparkContext.defaultParallelism and spark.conf.get(setting) == before
    back = layout.read_cohort(spark, path).withColumn("f", F.input_file_name())
    assert back.count() == 6000 and back.select("subject_id", "f").distinct().count() == 300 and back.select("f").distinct().count() > 50


def test_large_shards_are_several_files(spark, tmp_path, monkeypatch):
    """no task sorts more events than it should, however large a shard may be; merged ones included."""
    monkeypatch.setattr(layout, "TASK_ROWS", 500)
    events, path = spark.range(6000).selectExpr("id % 300 + 2 as subject_id", "cast(null as timestamp_ntz) as time", "'c' as code", "cast(id as float) as numeric_value"), str(tmp_path / "c")
    splits = spark.range(2, 302).selectExpr("id as subject_id", "if(id < 270, 'a', 'b') as split")
    write_cohort(events.filter("numeric_value < 4000"), splits, path)
    for n in (4000, 6000):
        if n == 6000:
            assert merge_cohort(events, splits, path) == 2
        back = spark.read.parquet(path).withColumn("f", F.input_file_name())
        sizes = [r["count"] for r in back.groupBy("f").count().collect()]
        assert sum(sizes) == n and max(sizes) <= 2 * 500 + 20 and len(sizes) >= n / 1020
        assert back.select("subject_id", "f").distinct().count() == 300 and back.select("split", "shard").distinct().count() == 2
    assert back.select("subject_id", "numeric_value").distinct().count() == 6000


def test_repeats_go_within_bounded_tasks(spark, monkeypatch):
    """events are dealt before repeated ones go, over tasks by their number."""
    monkeypatch.setattr(layout, "TASK_ROWS", 500)
    events = some_events(spark)
    for whole_subjects in (False, True):
        df = cohort.cohort(events, events, rows=12_000, whole_subjects=whole_subjects)
        assert df.rdd.getNumPartitions() == 24 and df.count() == 6000
        assert rows(df) == rows(cohort.cohort(events, events))
