import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventloom.errors import MissingColumns, SpecError
from eventloom.operators import audit, cohort, labs, lookups, shape, subjects
from eventloom.plans.spec import EventSpec

DAY = dt.datetime(2020, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_select_rename_names_with_dots_and_letters(spark):
    df = spark.createDataFrame([(1, 2)], "`Foster nr.` int, `Køn` int")
    assert shape.select_rename(df, {"Foster nr.": "n", "Køn": "gender"}).columns == ["n", "gender"]
    with pytest.raises(MissingColumns, match="absent"):
        shape.select_rename(df, {"absent": "x"})


def test_melt_keeps_null_rows_until_cleaning(spark):
    df = spark.createDataFrame([(1, "a", DAY, None), (2, "b", DAY, DAY)], "subject_id long, code string, t_in timestamp_ntz, t_out timestamp_ntz")
    long = shape.melt(df, {"t_in": "IN/", "t_out": "OUT/"}, "timestamp", "code")
    assert long.count() == 4
    assert {r.code for r in shape.drop_incomplete(long).collect()} == {"IN/a", "IN/b", "OUT/b"}
    assert plan(long).count("Scan") == 1


def test_unroll(spark):
    df = spark.createDataFrame([(1, DAY, "k", "x", None), (2, DAY, "l", "y", "z")], "subject_id long, timestamp timestamp_ntz, code string, a string, b string")
    out = shape.unroll(df, {"a": "A/", "b": "B/", "missing": "M/"})
    assert out.columns == ["subject_id", "timestamp", "code"]
    assert sorted(r.code for r in shape.drop_incomplete(out).collect()) == ["A/x", "A/y", "B/z"]
    assert sorted(r.code for r in shape.unroll(df, {"a": "A/"}, keep_code=True).collect()) == ["A/x", "A/y", "k", "l"]
    assert shape.unroll(df, {"missing": "M/"}) is df
    assert [r.code for r in shape.unroll(df, {"b": "B/"}, null_literal="nan").collect()] == ["B/nan", "B/z"]


def test_stack_and_incomplete(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert rows(shape.stack(a, b)) == [(1, "x"), (2, None)] or rows(shape.stack(a, b)) == [(2, None), (1, "x")]
    assert shape.drop_incomplete(a) is a


def test_lookup_kinds(spark):
    looked_up = partial(lookups.lookup, drop_source=True)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    side = spark.createDataFrame([("a", 10), ("a", 11), (None, 12), ("z", 13)], "key string, v int")
    assert rows(looked_up(df, side, "k", "key", {"v": "v"})) == [(1, 10), (1, 11)]
    assert rows(looked_up(df, side, "k", "key", {"v": "v"}, dedupe=True)) == [(1, 10)]
    assert rows(looked_up(df, side, "k", "key", {"v": "v"}, null_keys_match=True)) == [(1, 10), (1, 11), (3, 12)]
    assert len(rows(looked_up(df, side, "k", "key", {"v": "v"}, "left"))) == 4
    assert len(rows(looked_up(df, side, "k", "key", {"v": "v"}, "outer", drop_source=False))) == 6
    number = spark.createDataFrame([(1, "x")], "key long, v string")
    assert rows(looked_up(spark.createDataFrame([("1",)], "k string"), number, "k", "key", {"v": "v"})) == [("x",)]
    assert lookups.lookup(df, side, "k", "key", {"v": "v"}).columns == ["i", "k", "v"]
    with pytest.raises(ValueError, match="how"):
        looked_up(df, side, "k", "key", {"v": "v"}, "cross")


def test_subject_ids_are_dense_and_in_order(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "b", "ø", "😀", "Z"]], "k string")
    ids = subjects.subject_ids(df, "k")
    assert [r.source_id for r in ids.orderBy("subject_id").collect()] == ["Z", "a", "b", "ø", "😀"]
    assert [r.subject_id for r in ids.orderBy("subject_id").collect()] == [2, 3, 4, 5, 6]
    many = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = subjects.subject_ids(many.repartition(13), "k").orderBy("subject_id").collect()
    assert [r.subject_id for r in got] == list(range(2, 5002))
    assert [r.source_id for r in got] == sorted(r.source_id for r in got)


def test_map_subjects_filters(spark):
    df = spark.createDataFrame([("a", 1), ("q", 2), (None, 3)], "subject_id string, v int")
    ids = spark.createDataFrame([("a", 2)], "source_id string, subject_id long")
    assert rows(subjects.map_subjects(df, ids)) == [(2, 1)]


def lab(spark):
    data = [("A", str(v)) for v in range(1, 101)] + [("B", "5"), ("C", "1"), ("C", "1"), ("A", "Positive"), (None, "3"), ("D", "<25")]
    return spark.createDataFrame(data, "code string, numeric_value string")


def test_minmax(spark):
    out = labs.normalise(lab(spark), "minmax")
    by = {(r.code, r.value_label) for r in out.collect() if r.value_label}
    assert by == {("B", "UNIQUE"), ("C", "UNIQUE"), ("A", "Positive"), (None, "N/A"), ("D", "<25")}
    scaled = [r.numeric_value for r in out.filter("code = 'A' and numeric_value is not null").collect()]
    assert min(scaled) == 0.0 and max(scaled) == 1.0 and len(scaled) == 100
    text = labs.normalise(lab(spark), "minmax", single_column=True)
    assert text.schema["numeric_value"].dataType.simpleString() == "string" and "value_label" not in text.columns


def test_sorted_and_exact_percentiles_agree(spark, monkeypatch):
    monkeypatch.setattr(labs, "TASK_VALUES", 50)
    for method in labs.METHODS:
        by_size = {r.code: r.cuts for r in labs.fit(lab(spark), method).collect()}
        exact = {r.code: r.cuts for r in labs.fit(lab(spark), method, how="exact").collect()}
        by_sort = {r.code: r.cuts for r in labs.fit(lab(spark), method, how="sorted").collect()}
        assert exact.keys() == by_sort.keys() and by_size == by_sort
        for code, cuts in exact.items():
            assert by_sort[code] == pytest.approx(cuts, abs=1e-9)


def test_quantile_labels(spark):
    stats = spark.createDataFrame([("A", [1.0, 2.0, 3.0])], "code string, cuts array<double>")
    df = spark.createDataFrame([(0, "A", "0.5"), (1, "A", "1"), (2, "A", "2.5"), (3, "A", "9"), (4, "Z", "1")], "i int, code string, numeric_value string")
    assert [r.value_label for r in labs.apply(df, stats, "quantile", 3).orderBy("i").collect()] == ["Q1", "Q1", "Q3", "Q3", "N/A"]
    assert [r.value_label for r in labs.apply(df, stats, "category").orderBy("i").collect()] == ["Q1", "Q1", "Q3", "Q4", "N/A"]
    with pytest.raises(ValueError, match="method"):
        labs.normalise(df, "zscore")


def test_events(spark):
    df = spark.createDataFrame([(1, "m", "2020-01-01", "1.5"), (2, None, "bad", "x"), (None, "f", "2020-01-01", "1")], "subject_id long, g string, t string, v string")
    specs = {"gender": EventSpec(["G", "col(g)"]), "visit": EventSpec("V", "col(t)", numeric_value="col(v)")}
    out = cohort.events(df, specs)
    assert rows(out) == rows(spark.createDataFrame([(1, None, "G//m", None), (1, DAY, "V", 1.5)], out.schema))
    ordered = cohort.ordered(out).orderBy("position").collect()
    assert [r.code for r in ordered] == ["G//m", "V"]
    with pytest.raises(SpecError):
        cohort.events(df, {})


def test_splits(spark):
    df = spark.range(2000).select(F.col("id").alias("subject_id"))
    by_hash = cohort.split_subjects(df)
    assert by_hash.count() == 2000 and by_hash.select("subject_id").distinct().count() == 2000
    exact = {r.split: r["count"] for r in cohort.split_subjects(df, exact=True).groupBy("split").count().collect()}
    assert exact == {"train": 1600, "tuning": 200, "held_out": 200}
    given = spark.createDataFrame([(5, "held_out")], "subject_id long, split string")
    assert cohort.split_subjects(df, override=given).filter("subject_id = 5").first().split == "held_out"
    with pytest.raises(SpecError):
        cohort.split_subjects(df, {"a": 0.5, "b": 0.1})


def test_cohort_files(spark, tmp_path):
    events = spark.range(500).select((F.col("id") % 50).alias("subject_id"), F.lit(DAY).alias("time"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"), F.lit(1.0).alias("numeric_value"))
    splits = cohort.split_subjects(events)
    cohort.write_cohort(cohort.cohort(events), splits, str(tmp_path / "c"), partitions=3)
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.count() == 500
    places = back.select("subject_id", F.input_file_name().alias("f")).distinct()
    assert places.count() == 50
    meta = cohort.dataset_metadata(events, splits, "n", "1").first()
    assert meta.n_events == 500 and sum(meta.subjects_by_split.values()) == 50
    codes = cohort.code_metadata(events.withColumn("code", F.lit("x"))).first()
    assert (codes.n_events, codes.n_subjects, codes.value_sum) == (500, 50, 500.0)


def test_audits(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    assert tuple(audit.link_coverage(child, parent, "k", "p").first()) == (5, 1, 1, 3, 1, 2)
    assert rows(audit.repeated_links(child, "k")) == [(1, 2)]
    df = spark.createDataFrame([("aaaa", "1"), ("bbbb", "INVALID"), ("cc", "2"), (None, None)], "id string, v string")
    got = {r.column: (r.rows, r.nulls, r.all_null_rows, r.non_numeric, r.truncated) for r in audit.defect_profile(df, ["id", "v"], ["v"], ["id"]).collect()}
    assert got == {"id": (4, 1, 1, None, 1), "v": (4, 1, 1, 1, None)}
    assert audit.pseudonymise(df, "id", "s").filter("id is null").count() == 1


def test_saved_statistics_are_used_again(spark, tmp_path):
    first = labs.normalise(lab(spark), "minmax", statistics=str(tmp_path / "stats"))
    more = spark.createDataFrame([("A", "50.5"), ("A", "1000"), ("E", "1")], "code string, numeric_value string")
    assert first.count() == 106
    got = rows(labs.normalise(more, "minmax", statistics=str(tmp_path / "stats")))
    assert got == rows(spark.createDataFrame([("A", 0.5, None), ("A", 1.0, None), ("E", None, "N/A")], "code string, v double, l string"))


def test_splits_from_json_and_metadata_to_json(spark, tmp_path):
    (tmp_path / "splits.json").write_text('{"train": [1, 2],\n "held_out": [3], "none": []}')
    given = cohort.read_splits(spark, str(tmp_path / "splits.json"))
    assert rows(given) == [(1, "train"), (2, "train"), (3, "held_out")]
    subjects_ = spark.createDataFrame([(i,) for i in range(1, 9)], "subject_id long")
    got = {r.subject_id: r.split for r in cohort.split_subjects(subjects_, override=given).collect()}
    assert len(got) == 8 and (got[1], got[2], got[3]) == ("train", "train", "held_out")
    events = spark.createDataFrame([(1, DAY, "A", 1.0), (1, None, "B", None), (4, DAY, "A", None)], "subject_id long, time timestamp_ntz, code string, numeric_value float")
    meta = cohort.dataset_metadata(events, cohort.split_subjects(subjects_, override=given), "d", "1")
    cohort.write_metadata(meta, str(tmp_path / "meta"))
    back = spark.read.json(str(tmp_path / "meta")).first()
    assert (back.dataset_name, back.n_events, back.n_subjects) == ("d", 3, 2) and sum(v or 0 for v in back.subjects_by_split.asDict().values()) == 8
    assert {r.code: (r.n_events, r.n_values, r.value_sum, r.value_sum_sq) for r in cohort.code_metadata(events).collect()} == {"A": (2, 1, 1.0, 1.0), "B": (1, 0, None, None)}


def test_cohort_keeps_subjects_whole(spark, tmp_path):
    from pathlib import Path

    events = spark.range(4000).selectExpr("id % 97 as subject_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, int(id % 50)) as time", "concat('c', id % 7) as code", "cast(id as float) as numeric_value")
    splits = cohort.split_subjects(events)
    cohort.write_cohort(events, splits, str(tmp_path / "out"), partitions=6)
    files: dict = {}
    for path in Path(tmp_path / "out").rglob("*.parquet"):
        found = spark.read.parquet(str(path)).collect()
        order = [(r.subject_id, r.time, r.code) for r in found]
        assert order == sorted(order)
        for r in found:
            files.setdefault(r.subject_id, set()).add(path.name)
    assert len(files) == 97 and all(len(f) == 1 for f in files.values())
    assert len({f for fs in files.values() for f in fs}) == 6
