"""Pipelines from nested configurations, as YAML files hold them, in the key names that such files have used so far.

``pipeline_from`` gives the same ``PipelineSpec`` that one would write by hand; ``run_config`` runs it to where the
configuration says. Keys of a table that nothing reads are an error, so that a misspelt step is not left out silently.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

from eventloom.errors import SpecError
from eventloom.plans.run import TableReport, run_pipeline
from eventloom.plans.spec import DateTimeSpec, EventSpec, FileSpec, FillSpec, LookupSpec, MeltSpec, PartsSpec, PipelineSpec, TableSpec

#: Texts of delimited files that are missing values in such configurations (fixed values).
NULL_WORDS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Names of encodings where those of the reader differ from the usual ones.
ENCODINGS = {"iso8859-1": "ISO-8859-1", "utf-8": "UTF-8", "ascii": "US-ASCII", "utf-16": "UTF-16"}
#: Event tables read two chunks in a test run.
TEST_CHUNKS, CHUNK_ROWS = 2, 500_000

_reference = re.compile(r"\$\{(oc\.env:)?([^${}]+)\}")


def read_config(path: str) -> dict:
    """A YAML file as nested dicts; needs the yaml package."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def filled(config: Mapping, env: Mapping[str, str] | None = None) -> dict:
    """The configuration with every ``${a.b}`` replaced by its own value there, and ``${oc.env:NAME}`` or
    ``${oc.env:NAME,default}`` by the environment's."""
    env = os.environ if env is None else env

    def value(m: re.Match, seen: tuple[str, ...]) -> str:
        name = m[2].strip()
        if m[1]:
            name, comma, default = name.partition(",")
            found = env.get(name, default if comma else None)
        else:
            found = config
            for part in name.split("."):
                found = found.get(part) if isinstance(found, Mapping) else None
        if found is None or isinstance(found, Mapping | list) or name in seen:
            raise SpecError(f"{m[0]} has no value")
        return text(str(found), (*seen, name))

    def text(x: str, seen: tuple[str, ...] = ()) -> str:
        return _reference.sub(lambda m: value(m, seen), x)

    def walk(x):
        if isinstance(x, Mapping):
            return {k: walk(v) for k, v in x.items()}
        if isinstance(x, list | tuple):
            return [walk(v) for v in x]
        return text(x) if isinstance(x, str) else x

    return {k: walk(v) for k, v in config.items() if k in ("tables", "patients_info", "paths", "align_timestamps", "write_file_type", "test", "chunksize")}


def known(where: str, given: Mapping, *keys: str) -> Mapping:
    unknown = set(given) - set(keys)
    if unknown:
        raise SpecError(f"{where}: nothing reads {', '.join(sorted(unknown))}; there are {', '.join(keys)}")
    return given


def file_from(where: str, path: str, info: Mapping | None = None, file_type: str | None = None) -> FileSpec:
    info = known(where, info or {}, "sep", "encoding", "quotechar", "escapechar", "na_values")
    encoding = info.get("encoding", "UTF-8")
    words = info.get("na_values", [])
    more = {"quote": info["quotechar"]} if "quotechar" in info else {}
    more |= {"escape": info["escapechar"]} if "escapechar" in info else {}
    null_words = (*NULL_WORDS, *([words] if isinstance(words, str) else words))
    return FileSpec(path, file_type, info.get("sep", ","), ENCODINGS.get(codecs.lookup(encoding).name, encoding), null_words=null_words, **more)


def lookup_from(where: str, m: Mapping) -> LookupSpec:
    known(where, m, "source_column", "via_file", "join_on", "target_column", "rename_to", "how", "drop_source")
    return LookupSpec(file_from(where, m["via_file"]), m["source_column"], m["join_on"], {m["target_column"]: m["rename_to"]}, m.get("how", "inner"), m.get("drop_source", False))


def melt_from(where: str, m: Mapping) -> MeltSpec:
    known(where, m, "target_name", "source_cols", "prefix_col", "prefix_map")
    lacking = [c for c in m["source_cols"] if c not in m["prefix_map"]]
    if lacking:
        raise SpecError(f"{where}: no prefix for {', '.join(lacking)}")
    return MeltSpec({c: m["prefix_map"][c] for c in m["source_cols"]}, m["target_name"], m["prefix_col"])


def table_from(name: str, table: Mapping, times: tuple[str, ...] = ("timestamp",)) -> TableSpec:
    known(
        name, table, "filename", "file_info", "file_type", "rename_columns", "normalize_columns", "value_map", "mappings", "pad_values", "fillna",
        "melt_table", "combine_datetime", "combine_datetime_parts", "code_prefix", "unroll_columns", "numeric_columns",
    )
    part = lambda key: (table.get(key) or {}).items()
    each = lambda key: table.get(key) or ()
    for key, keys in (("fillna", ("column", "regex", "value")), ("combine_datetime", ("date_col", "time_col", "drop_original")), ("combine_datetime_parts", ("date_col", "hour_col", "minute_col", "drop_original")), ("pad_values", ("suffix", "unless_contains"))):
        for target, given in part(key):
            known(f"{name}.{key}.{target}", given, *keys)
    return TableSpec(
        file_from(name, table["filename"], table.get("file_info"), table.get("file_type")),
        dict(table["rename_columns"]),
        strip_zeros=tuple(each("normalize_columns")),
        value_maps={c: {str(k): v for k, v in m.items()} for c, m in part("value_map")},
        lookups=tuple(lookup_from(f"{name}.mappings", m) for m in each("mappings")),
        pad=dict(part("pad_values")),
        fill=tuple(FillSpec(c, f.get("column"), f.get("regex"), f.get("value")) for c, f in part("fillna")),
        melt=tuple(melt_from(f"{name}.melt_table", m) for m in each("melt_table")),
        date_times=tuple(DateTimeSpec(c, p["date_col"], p["time_col"], p.get("drop_original", True)) for c, p in part("combine_datetime")),
        parts=tuple(PartsSpec(c, p["date_col"], p["hour_col"], p["minute_col"], p.get("drop_original", True)) for c, p in part("combine_datetime_parts")),
        code_prefix=table.get("code_prefix"),
        unroll={known(f"{name}.unroll_columns", u, "column", "prefix")["column"]: u.get("prefix", "") for u in each("unroll_columns")},
        numeric=tuple(each("numeric_columns")),
        times=times,
    )


def events_from(config: Mapping) -> tuple[dict[str, dict[str, EventSpec]], dict[str, str]]:
    """(events by table, subject column by table) of an event configuration."""
    out, columns = {}, {}
    for name, table in config.items():
        if not isinstance(table, Mapping):
            continue
        columns[name] = table.get("subject_id_col", config.get("subject_id_col", "subject_id"))
        out[name] = {}
        for event, e in table.items():
            if isinstance(e, Mapping):
                known(f"{name}.{event}", e, "code", "time", "time_format", "numeric_value")
                code = e["code"] if isinstance(e["code"], str) else tuple(e["code"])
                formats = e.get("time_format") or ()
                out[name][event] = EventSpec(code, e.get("time"), (formats,) if isinstance(formats, str) else tuple(formats), e.get("numeric_value"))
    return out, columns


def pipeline_from(config: Mapping, events: Mapping | None = None, env: Mapping[str, str] | None = None) -> PipelineSpec:
    """The pipeline of a table configuration and, if given, an event configuration."""
    config = filled(config, env)
    times = tuple((config.get("align_timestamps") or {}).get("names", ()))
    patients = known("patients_info", config["patients_info"], "filename", "file_info", "file_type", "rename_columns")
    tables = {name: table_from(name, t, times) for name, t in (config.get("tables") or {}).items()}
    of_events, columns = events_from(events) if events else ({}, {})
    return PipelineSpec(file_from("patients_info", patients["filename"], patients.get("file_info"), patients.get("file_type")), dict(patients["rename_columns"]), tables, of_events, subject_columns=columns)


def dataset_options(config: Mapping) -> dict:
    """Splits, their file, name and version, as ``build_dataset`` takes them, of a dataset configuration."""
    split = (config.get("stage_configs") or {}).get("split_and_shard_subjects") or {}
    named = config.get("etl_metadata") or {}
    found = {"splits": split.get("split_fracs"), "splits_json": split.get("external_splits_json_fp"), "name": named.get("dataset_name"), "version": named.get("dataset_version")}
    return {k: str(v) if k in ("name", "version") else v for k, v in found.items() if v is not None}


def run_config(spark: SparkSession, config: Mapping, out: str | None = None, env: Mapping[str, str] | None = None, **options) -> list[TableReport]:
    """``run_pipeline`` as the configuration says: output folder, file type, and in a test run two chunks of each table."""
    spec, given = pipeline_from(config, env=env), filled(config, env)
    if given.get("test"):
        options.setdefault("test_rows", TEST_CHUNKS * int(given.get("chunksize", CHUNK_ROWS)))
    return run_pipeline(spark, spec, out or given["paths"]["output"], given.get("write_file_type", "parquet"), **options)
