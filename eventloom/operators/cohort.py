"""Events and cohort (M1-M14, A9, O4); how a cohort is written is in ``layout``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.errors import SpecError
from eventloom.functions.columns import named, to_number
from eventloom.functions.times import ISO, parse_time
from eventloom.operators.layout import dealt_by_subject, tasks_for
from eventloom.operators.layout import merge_cohort as merge_cohort
from eventloom.operators.layout import read_cohort as read_cohort
from eventloom.operators.layout import write_cohort as write_cohort
from eventloom.operators.shape import require, stack
from eventloom.operators.subjects import subject_ids

SPLITS = {"train": 0.8, "tuning": 0.1, "held_out": 0.1}
SEPARATOR = "//"
_column = re.compile(r"^col\((.+)\)$")


@dataclass(frozen=True)
class EventSpec:
    """One kind of event of a table: code from literals and ``col(name)``, time column or None for a static event."""

    code: str | Sequence[str]
    time: str | None = None
    time_formats: Sequence[str] = ()
    numeric_value: str | None = None


def column_of(part: str) -> str | None:
    """The name in ``col(name)``; None for a literal."""
    m = _column.match(part.strip())
    return m[1] if m else None


def event_code(parts: str | Sequence[str], separator: str = SEPARATOR) -> Column:
    """Literals and columns joined by a separator; null if any of the columns is."""
    out = []
    for i, part in enumerate([parts] if isinstance(parts, str) else parts):
        name = column_of(part)
        out += ([F.lit(separator)] if i else []) + [named(name).cast("string") if name else F.lit(part)]
    return F.concat(*out)


def event_struct(df: DataFrame, spec: EventSpec, separator: str) -> Column:
    if spec.time is None:
        time = F.lit(None).cast("timestamp_ntz")
    else:
        name = column_of(spec.time) or spec.time
        require(df, [name])
        time = parse_time(named(name), spec.time_formats or ISO, df.schema[name].dataType)
    value = F.lit(None).cast("double") if spec.numeric_value is None else to_number(named(column_of(spec.numeric_value) or spec.numeric_value))
    return F.struct(F.lit(spec.time is None).alias("static"), time.alias("time"), event_code(spec.code, separator).alias("code"), value.alias("numeric_value"))


def events(df: DataFrame, specs: Mapping[str, EventSpec], subject: str = "subject_id", separator: str = SEPARATOR) -> DataFrame:
    """(subject_id, time, code, numeric_value): all events of every row, in one pass.

    A static event has no time. A timed event without a readable time is left out, and so is one without a code or a
    subject.
    """
    if not specs:
        raise SpecError("no events are described")
    require(df, [subject])
    each = df.select(named(subject).cast("bigint").alias("subject_id"), F.explode(F.array(*(event_struct(df, s, separator) for s in specs.values()))).alias("e"))
    kept = each.filter("subject_id is not null and e.code is not null and (e.static or e.time is not null)")
    return kept.select("subject_id", "e.time", "e.code", "e.numeric_value")


def cohort(*parts: DataFrame, dedupe: bool = True, rows: int | None = None, whole_subjects: bool = False) -> DataFrame:
    """Events of all tables in the final schema: subject_id long, time, code, numeric_value float.

    ``rows`` says about how many they are: they are then dealt over tasks of a bounded number of rows before repeated ones
    go, or else every reading task first gathers all the different rows of its share of the input. ``whole_subjects``
    deals them by subject, for what keeps subjects whole in any case and so needs no other shuffle.
    """
    out = stack(*parts).select(F.col("subject_id").cast("bigint").alias("subject_id"), F.col("time").cast("timestamp_ntz").alias("time"), F.col("code").cast("string").alias("code"), F.col("numeric_value").cast("float").alias("numeric_value"))
    if dedupe and rows is not None:
        out = dealt_by_subject(out, rows) if whole_subjects else out.repartition(tasks_for(out.sparkSession, rows), *out.columns)
    return out.dropDuplicates() if dedupe else out


def bucket(c: Column) -> Column:
    """A number from 0 to 1 that is fixed for each id."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def share_label(x: Column, splits: Mapping[str, float]) -> Column:
    if abs(sum(splits.values()) - 1) > 1e-9:
        raise SpecError(f"split fractions add up to {sum(splits.values())}")
    names, total, out = list(splits), 0.0, None
    for name in names[:-1]:
        total += splits[name]
        out = F.when(x < total, name) if out is None else out.when(x < total, name)
    return F.lit(names[0]) if out is None else out.otherwise(names[-1])


def one_split(given: DataFrame) -> DataFrame:
    """(subject_id, split) once for each subject; one that has several splits is an error."""
    each = given.filter("subject_id is not null and split is not null").groupBy("subject_id").agg(F.min("split").alias("split"), F.max("split").alias("other"))
    message = F.concat(F.lit("subject "), F.col("subject_id").cast("string"), F.lit(" is in splits "), F.col("split"), F.lit(" and "), F.col("other"))
    return each.select("subject_id", F.when(F.col("split") == F.col("other"), F.col("split")).otherwise(F.raise_error(message)).alias("split"))


def split_subjects(subjects: DataFrame, splits: Mapping[str, float] = SPLITS, exact: bool = False, override: DataFrame | None = None, id_column: str = "subject_id") -> DataFrame:
    """(subject_id, split): by a hash of the id, or with ``exact`` by its rank so that the sizes match to one subject.

    ``override`` (subject_id, split) goes first where it names a subject. A subject that it puts in two splits is an error
    when rows are read, as no subject may be trained on and held out.
    """
    ids = subjects.select(named(id_column).alias("subject_id")).filter("subject_id is not null").distinct()
    if exact:
        keyed = ids.withColumn("key", F.concat_ws(":", F.md5(F.col("subject_id").cast("string")), F.col("subject_id").cast("string")))
        ranks = subject_ids(keyed, "key", first=0).select(F.col("source_id").alias("key"), F.col("subject_id").alias("rank"))
        out = keyed.join(ranks, "key").select("subject_id", share_label(F.col("rank") / F.lit(max(keyed.count(), 1)), splits).alias("split"))
    else:
        out = ids.select("subject_id", share_label(bucket(F.col("subject_id")), splits).alias("split"))
    if override is not None:
        given = one_split(override).select(F.col("subject_id").alias("__id"), F.col("split").alias("__split"))
        out = out.join(given, F.col("subject_id") == F.col("__id"), "left").select("subject_id", F.coalesce("__split", "split").alias("split"))
    return out


def ordered(events_: DataFrame) -> DataFrame:
    """Events with their place (from 1) within the subject: static ones first, then by time, code and value."""
    order = Window.partitionBy("subject_id").orderBy(F.col("time").asc_nulls_first(), "code", F.col("numeric_value").asc_nulls_first())
    return events_.withColumn("position", F.row_number().over(order))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """(subject_id, split) from JSON files of one object each: split names as keys, lists of subject ids as values. A subject
    under two names is an error."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, array<bigint>>").alias("m"))
    return one_split(whole.select(F.explode("m")).select(F.explode("value").alias("subject_id"), F.col("key").alias("split")))


def code_metadata(events_: DataFrame) -> DataFrame:
    """One row a code: n_events, n_subjects, n_values, value_sum, value_sum_sq, value_min, value_max.

    Subjects are counted in two steps (by code and subject, then by code), so a frequent code is combined before it
    is shuffled and no task holds its subjects.
    """
    v = F.col("numeric_value").cast("double")
    per = events_.groupBy("code", "subject_id").agg(F.count("*").alias("n"), F.count(v).alias("k"), F.sum(v).alias("s"), F.sum(v * v).alias("q"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    return per.groupBy("code").agg(
        F.sum("n").alias("n_events"), F.count("*").alias("n_subjects"), F.sum("k").alias("n_values"), F.sum("s").alias("value_sum"), F.sum("q").alias("value_sum_sq"), F.min("lo").alias("value_min"), F.max("hi").alias("value_max")
    )


def code_states(events_: DataFrame) -> DataFrame:
    """(code, bucket, subjects, n, k, s, q, lo, hi): what ``code_metadata`` needs of these events, in a form that adds up.

    Subjects of a code are bitmaps of their dense ids, one for each bucket of 32,768 ids (4 kB at most), so a code's
    subjects spread over as many rows as its ids over buckets. Only subjects with a number of 1 or more can be held.
    """
    v, bit = F.col("numeric_value").cast("double"), F.bitmap_bit_position("subject_id")
    return events_.groupBy("code", F.bitmap_bucket_number("subject_id").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("subjects"), F.count("*").alias("n"), F.count(v).alias("k"), F.sum(v).alias("s"), F.sum(v * v).alias("q"), F.min(v).alias("lo"), F.max(v).alias("hi")
    )


def merged_states(*states: DataFrame) -> DataFrame:
    """The states of all events behind several; a subject that several of them know counts once."""
    return stack(*states).groupBy("code", "bucket").agg(F.bitmap_or_agg("subjects").alias("subjects"), *(f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "k"), (F.sum, "s"), (F.sum, "q"), (F.min, "lo"), (F.max, "hi"))))


def metadata_of_states(states: DataFrame) -> DataFrame:
    """``code_metadata`` of the events behind the states, which are not read again. Events must not lie in two of them."""
    return states.groupBy("code").agg(
        F.sum("n").alias("n_events"), F.sum(F.bitmap_count("subjects")).alias("n_subjects"), F.sum("k").alias("n_values"), F.sum("s").alias("value_sum"), F.sum("q").alias("value_sum_sq"), F.min("lo").alias("value_min"), F.max("hi").alias("value_max")
    )


def dataset_metadata(events_: DataFrame, splits: DataFrame, name: str, version: str) -> DataFrame:
    """One row: dataset_name, dataset_version, n_events, n_subjects, and subjects of each split as a map."""
    per_subject = events_.groupBy("subject_id").agg(F.count("*").alias("n"))
    sizes = per_subject.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"), F.count("*").alias("n_subjects"))
    per_split = splits.groupBy("split").agg(F.count("*").alias("n"))
    by_split = per_split.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "n")))).alias("subjects_by_split"))
    both = sizes.unionByName(by_split, allowMissingColumns=True)
    return both.agg(F.lit(name).alias("dataset_name"), F.lit(version).alias("dataset_version"), F.max("n_events").alias("n_events"), F.max("n_subjects").alias("n_subjects"), F.first("subjects_by_split", ignorenulls=True).alias("subjects_by_split"))


def write_metadata(metadata: DataFrame, path: str) -> None:
    """Dataset metadata (one row) as a JSON file in the folder ``path``."""
    metadata.coalesce(1).write.mode("overwrite").json(path)
