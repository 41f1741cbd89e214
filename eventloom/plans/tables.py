"""A table description compiled to one lazy plan (L1), in the fixed order

strip zeros, map values (raw names), select and rename, lookups, pad, fill, melt, date + time, date + parts, prefix,
unroll, numbers, times, known subjects, complete rows, no repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from eventloom.functions.columns import from_value_map, named, pad_suffix, prefixed, strip_zeros, to_number
from eventloom.functions.times import combine_date_time, combine_parts, parse_time
from eventloom.operators.lookups import lookup
from eventloom.operators.shape import drop_incomplete, drop_repeats, fill_nulls, melt, require, select_rename, unroll
from eventloom.operators.subjects import map_subjects
from eventloom.plans.spec import FileSpec, LookupSpec, TableSpec
from eventloom.sources.readers import read_table


def read_file(spark: SparkSession, file: FileSpec, columns=None) -> DataFrame:
    return read_table(spark, file.path, columns, file.file_format, file.sep, file.encoding, quote=file.quote, escape=file.escape, multi_line=file.multi_line, null_words=file.null_words)


Watch = Callable[[str, DataFrame], DataFrame]


def unwatched(stage: str, df: DataFrame) -> DataFrame:
    return df


def joins_with(first: LookupSpec, between: list[LookupSpec], look: LookupSpec) -> bool:
    """Whether ``look`` can be done by the join of ``first``, with ``between`` done after it, and give the same rows (but that k
    equal keys give k rows, not k * k).

    Both bring columns of one file by one key, and only inner and left joins may change places. No lookup from ``first`` on
    writes the key's column; none between reads or writes what ``look`` brings; and both have different columns and names.
    """
    same = lambda o: (o.file, o.on, o.key, o.how, o.null_keys_match, o.dedupe)
    if same(first) != same(look) or any(o.how not in ("inner", "left") for o in (first, *between)):
        return False
    brought = set(look.targets.values())
    if any(look.on in o.targets.values() for o in (first, *between)) or look.on in brought:
        return False
    if any(o.on in brought or brought & set(o.targets.values()) for o in between):
        return False
    return not (set(first.targets) & set(look.targets) or set(first.targets.values()) & brought)


def combined(lookups: list[LookupSpec]) -> list[LookupSpec]:
    """Lookups of the same file by the same key as one with all targets (J7), wherever ``joins_with`` allows it: the file is
    read and joined once. The key's column goes after its last use, as ``dropping`` says."""
    out: list[LookupSpec] = []
    for look in lookups:
        at = next((i for i, o in enumerate(out) if joins_with(o, out[i + 1 :], look)), None)
        if at is None:
            out.append(look)
        else:
            first = out[at]
            out[at] = replace(first, targets={**first.targets, **look.targets}, drop_source=first.drop_source or look.drop_source, salts=max(first.salts, look.salts))
    return out


def dropping(lookups: Sequence[LookupSpec]) -> list[bool]:
    """For each lookup, whether its key's column goes with it: one of the lookups by that column says so, and no later one
    reads the column before it is written anew."""
    out, asked = [], set()
    for i, look in enumerate(lookups):
        if look.drop_source:
            asked.add(look.on)
        later = next((o for o in lookups[i + 1 :] if look.on in (o.on, *o.targets.values())), None)
        out.append(look.on in asked and not (later and later.on == look.on))
        asked -= {*look.targets.values(), *([look.on] if out[-1] else [])}
    return out


def touched(spec: TableSpec) -> set[str]:
    """Columns that some step after the renaming reads or writes."""
    out = {"code", *spec.pad, *spec.unroll, *spec.numeric, *spec.times}
    out.update(*((look.on, *look.targets.values()) for look in spec.lookups), *((f.target, f.source) for f in spec.fill))
    out.update(*((*m.columns, m.into, m.prefix_column) for m in spec.melt), *((d.target, d.date, d.time) for d in spec.date_times))
    out.update(*((p.target, p.date, p.hour, p.minute) for p in spec.parts))
    return out


def early_subjects(spec: TableSpec) -> bool:
    """Whether unknown subjects can go before rows multiply, with the same result as at the end: the id is in the table
    itself, no step reads or writes it, no join adds rows without it, and no bad time of an unknown subject is an error."""
    return spec.on_bad_time != "fail" and list(spec.rename.values()).count("subject_id") == 1 and "subject_id" not in touched(spec) and all(look.how in ("inner", "left") for look in spec.lookups)


def subject_finder(spec: TableSpec, lookups: Sequence[LookupSpec]) -> int | None:
    """The lookup whose side table can have its subjects mapped before the join, with the same result: an inner one that finds
    the subject, after which nothing reads or writes it and no join adds rows without it. Rows that it would find for
    unknown subjects are not even joined, and the table itself, which has many more rows, needs no join with the ids."""
    at = next((i for i in reversed(range(len(lookups))) if "subject_id" in lookups[i].targets.values()), None)
    if at is None or lookups[at].how != "inner" or lookups[at].dedupe or spec.on_bad_time == "fail":
        return None
    if "subject_id" in (lookups[at].on, lookups[at].targets.get(lookups[at].key)) or any(look.on == "subject_id" or look.how not in ("inner", "left") for look in lookups[at + 1 :]):
        return None
    return None if "subject_id" in touched(replace(spec, lookups=())) else at


def compile_table(spark: SparkSession, spec: TableSpec, id_map: DataFrame | None = None, raw: DataFrame | None = None, sides: dict[str, DataFrame] | None = None, test_rows: int | None = None, early: bool = True, watch: Watch = unwatched) -> DataFrame:
    """The event table of a description. ``raw`` and ``sides`` (by path) stand in for files that are tables already.

    Ids are mapped at the end, or first where that gives the same rows, or in the side table of the lookup that finds subjects
    where it does; ``early`` off does neither, and rows that are watched are those of all subjects. ``watch`` gets the table after each stage that may change its number of rows, and its name: read, known (subjects),
    lookups, shaped (melt and unroll), complete, distinct.
    """
    df = require(raw, list(spec.rename)).select(*map(named, spec.rename)) if raw is not None else read_file(spark, spec.file, list(spec.rename))
    if test_rows:
        df = df.limit(test_rows)
    df = watch("read", df)
    df = df.withColumns({c: strip_zeros(named(c)) for c in spec.strip_zeros})
    df = df.withColumns({c: from_value_map(named(c), m) for c, m in spec.value_maps.items()})
    df = select_rename(df, spec.rename)
    early_known, early = early, early and id_map is not None and early_subjects(spec)
    if early:
        df = watch("known", map_subjects(df, id_map))
    lookups = combined(list(spec.lookups)) if spec.combine_lookups else list(spec.lookups)
    finder = subject_finder(spec, lookups) if early_known and id_map is not None and watch is unwatched else None
    for i, (look, drop) in enumerate(zip(lookups, dropping(lookups), strict=True)):
        side = (sides or {}).get(look.file.path)
        side = side if side is not None else read_file(spark, look.file, [look.key, *look.targets])
        if i == finder:
            found = next(c for c, name in look.targets.items() if name == "subject_id")
            side = map_subjects(side, id_map, found)
        df = lookup(df, side, look.on, look.key, look.targets, look.how, drop, look.null_keys_match, look.dedupe, look.salts)
    df = watch("lookups", df) if lookups else df
    df = df.withColumns({c: pad_suffix(named(c), p["suffix"], p.get("unless_contains")) for c, p in spec.pad.items()})
    for f in spec.fill:
        df = fill_nulls(df, f.target, f.source, f.pattern, f.value)
    for m in spec.melt:
        df = melt(df, m.columns, m.into, m.prefix_column, spec.null_literal)
    for d in spec.date_times:
        df = require(df, [d.date, d.time]).withColumn(d.target, combine_date_time(named(d.date), named(d.time), spec.time_formats, df.schema[d.date].dataType))
        df = df.drop(*({d.date, d.time} - {d.target})) if d.drop else df
    for p in spec.parts:
        require(df, [p.date, p.hour, p.minute])
        df = df.withColumn(p.target, combine_parts(named(p.date), named(p.hour), named(p.minute), kind=df.schema[p.date].dataType))
        df = df.drop(*({p.date, p.hour, p.minute} - {p.target})) if p.drop else df
    if spec.code_prefix and "code" in df.columns:
        df = df.withColumn("code", prefixed(named("code"), spec.code_prefix, spec.null_literal))
    df = unroll(df, spec.unroll, spec.keep_code, spec.null_literal) if spec.unroll else df
    df = watch("shaped", df) if spec.unroll or spec.melt else df
    df = df.withColumns({c: to_number(named(c)) for c in spec.numeric if c in df.columns})
    df = df.withColumns({c: parse_time(named(c), spec.time_formats, df.schema[c].dataType, spec.on_bad_time) for c in spec.times if c in df.columns})
    if id_map is not None and not early and finder is None and "subject_id" in df.columns:
        df = watch("known", map_subjects(df, id_map))
    df = watch("complete", drop_incomplete(df))
    return watch("distinct", drop_repeats(df)) if spec.dedupe else df
