"""Static checks of a table description: combinations that read well and do something else."""

from __future__ import annotations

from eventloom.operators.cohort import column_of
from eventloom.plans.spec import EventSpec, PipelineSpec, TableSpec

#: The form in which a table's times are written as text.
ALIGNED = "%Y-%m-%d %H:%M:%S.%f"


def lint_table(name: str, spec: TableSpec) -> list[str]:
    out = []
    if spec.code_prefix and "code" in spec.unroll:
        out.append(f"{name}: code gets {spec.code_prefix!r} and, unrolled, {spec.unroll['code']!r} before it")
    if spec.unroll and "code" not in spec.unroll and not spec.keep_code and "code" in spec.rename.values():
        out.append(f"{name}: unroll drops the code column; list it or set keep_code")
    for column in spec.strip_zeros:
        lost = [k for k in spec.value_maps.get(column, ()) if k.isdigit() and k != str(int(k))]
        if lost:
            out.append(f"{name}: keys {lost} of {column} never match, as its leading zeros are stripped first")
    raw = set(spec.rename)
    for column in {*spec.strip_zeros, *spec.value_maps}:
        if column not in raw:
            out.append(f"{name}: {column} is repaired but not selected")
    seen = {}
    for look in spec.lookups:
        if (look.file, look.on, look.key) in seen and not spec.combine_lookups:
            out.append(f"{name}: {look.key} of {look.file.path} is joined twice; k rows of a key give k * k")
        seen[look.file, look.on, look.key] = True
    return out


def lint_events(name: str, table: TableSpec | None, events: dict[str, EventSpec], separator: str) -> list[str]:
    out = []
    for event, spec in events.items():
        parts = [spec.code] if isinstance(spec.code, str) else list(spec.code)
        if table and table.code_prefix and len(parts) > 1 and parts[0].rstrip("/") == table.code_prefix.rstrip("/"):
            out.append(f"{name}.{event}: {parts[0]!r} stands before codes that already begin with it")
        if table and spec.time and spec.time_formats and (column_of(spec.time) or spec.time) in table.times and ALIGNED not in spec.time_formats:
            out.append(f"{name}.{event}: the table's times have the form {ALIGNED}, which is none of {', '.join(spec.time_formats)}")
    return out


def lint(spec: PipelineSpec) -> list[str]:
    """Warnings for the whole pipeline; an empty list if there are none."""
    out = [w for name, table in spec.tables.items() for w in lint_table(name, table)]
    for name, events in spec.events.items():
        if name != "subject" and name not in spec.tables:
            out.append(f"events of {name}: there is no such table")
        out += lint_events(name, spec.tables.get(name), dict(events), spec.separator)
    return out
