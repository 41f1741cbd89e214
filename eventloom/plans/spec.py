"""Descriptions of tables, lookups, events and pipelines."""

from __future__ import annotations

from collections import abc
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields, is_dataclass
from types import UnionType
from typing import Union, get_args, get_origin, get_type_hints

from eventloom.errors import SpecError
from eventloom.functions.times import ISO
from eventloom.operators.cohort import EventSpec as EventSpec


def from_dict(kind, given: Mapping):
    """A description from plain dicts and lists, nested as its fields are; keys that it does not know are an error."""
    hints = get_type_hints(kind)
    unknown = set(given) - {f.name for f in fields(kind)}
    if unknown:
        raise SpecError(f"{kind.__name__} has no {', '.join(sorted(unknown))}; it has {', '.join(sorted(hints))}")
    return kind(**{name: built(hints[name], value) for name, value in given.items()})


def built(hint, value):
    """A value as its field's type asks: dicts become descriptions, lists tuples; anything else stays."""
    origin, inner = get_origin(hint), get_args(hint)
    if is_dataclass(hint):
        return from_dict(hint, value) if isinstance(value, Mapping) else value
    if origin is abc.Mapping and isinstance(value, Mapping):
        return {k: built(inner[1], v) for k, v in value.items()}
    if origin is abc.Sequence and isinstance(value, list | tuple):
        return tuple(built(inner[0], v) for v in value)
    if origin in (Union, UnionType):
        return next((built(h, value) for h in inner if get_origin(h) is abc.Sequence and isinstance(value, list)), value)
    return value


@dataclass(frozen=True)
class FileSpec:
    """Where a raw table lies and how it is read; ``null_words`` are texts that stand for a missing value."""

    path: str
    file_format: str | None = None
    sep: str = ","
    encoding: str = "UTF-8"
    quote: str = '"'
    escape: str = '"'
    multi_line: bool = False
    null_words: Sequence[str] = ()


@dataclass(frozen=True)
class LookupSpec:
    """Columns ``targets`` (side name -> new name) of a side file, by ``on`` = ``key``."""

    file: FileSpec
    on: str
    key: str
    targets: Mapping[str, str]
    how: str = "inner"
    drop_source: bool = False
    null_keys_match: bool = False
    dedupe: bool = False
    salts: int = 0  # tasks for each frequent key and for rows without one; see ``lookup``


@dataclass(frozen=True)
class FillSpec:
    target: str
    source: str | None = None
    pattern: str | None = None
    value: object = None


@dataclass(frozen=True)
class MeltSpec:
    columns: Mapping[str, str]
    into: str = "timestamp"
    prefix_column: str | None = "code"


@dataclass(frozen=True)
class DateTimeSpec:
    target: str
    date: str
    time: str
    drop: bool = True


@dataclass(frozen=True)
class PartsSpec:
    target: str
    date: str
    hour: str
    minute: str
    drop: bool = True


@dataclass(frozen=True)
class TableSpec:
    """One raw table and what is done to it, in the fixed order of the fields after ``rename``; see ``plans.tables``."""

    file: FileSpec
    rename: Mapping[str, str]
    strip_zeros: Sequence[str] = ()  # raw names
    value_maps: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # raw names
    lookups: Sequence[LookupSpec] = ()
    pad: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    fill: Sequence[FillSpec] = ()
    melt: Sequence[MeltSpec] = ()
    date_times: Sequence[DateTimeSpec] = ()
    parts: Sequence[PartsSpec] = ()
    code_prefix: str | None = None
    unroll: Mapping[str, str] = field(default_factory=dict)
    numeric: Sequence[str] = ()
    times: Sequence[str] = ("timestamp",)
    time_formats: Sequence[str] = ISO
    on_bad_time: str = "null"  # or fail
    null_literal: str | None = None
    keep_code: bool = False
    dedupe: bool = True
    combine_lookups: bool = True


@dataclass(frozen=True)
class PipelineSpec:
    """Patients and tables; events by table name, ``subject`` being the patients' own."""

    patients: FileSpec
    patients_rename: Mapping[str, str]
    tables: Mapping[str, TableSpec]
    events: Mapping[str, Mapping[str, EventSpec]] = field(default_factory=dict)
    separator: str = "//"
    subject_columns: Mapping[str, str] = field(default_factory=dict)
