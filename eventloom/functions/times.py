"""Times: texts in stated formats to timestamps without a zone.

A format is a short strptime pattern (%Y %m %d %b %H %M %S %f). Formats in ISO order are checked by one regular expression
and read by a cast; any other is rewritten to ISO order first. The session's time zone never matters, and what does not
fit is null.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.columns import to_number

ISO = ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DIRECTIVES = {"Y": r"(\d{4})", "m": r"(\d{1,2})", "d": r"(\d{1,2})", "b": r"([A-Za-z]{3})", "H": r"(\d{1,2})", "M": r"(\d{1,2})", "S": r"(\d{1,2})", "f": r"(\d{1,6})"}


def time_pattern(form: str) -> tuple[str, list[str]]:
    """Regular expression of a format, and its directives in order."""
    out, names, at = "", [], 0
    while at < len(form):
        if form[at] == "%":
            name = form[at + 1 : at + 2]
            if name not in DIRECTIVES:
                raise ValueError(f"format {form!r}: %{name} is none of {' '.join('%' + d for d in DIRECTIVES)}")
            out, at = out + DIRECTIVES[name], at + 2
            names.append(name)
        else:
            out, at = out + re.escape(form[at]), at + 1
    return f"^\\s*{out}\\s*$", names


#: A format whose texts a cast reads as they are.
_iso = re.compile(r"%Y-%m-%d([ T]%H:%M(:%S(\.%f)?)?)?")


def parse_iso(c: Column, formats: Sequence[str]) -> Column:
    """Texts in one of several ISO formats: one regular expression for all of them, and one cast."""
    pattern = "|".join(time_pattern(f)[0] for f in formats)
    return F.when(c.rlike(pattern), c).try_cast("timestamp_ntz")


def parse_text(c: Column, form: str) -> Column:
    """Texts in one format, brought to ISO order by one replacement."""
    pattern, names = time_pattern(form)
    part = lambda name, default: f"${names.index(name) + 1}" if name in names else default
    month = "@" if "b" in names else part("m", "1")
    iso = F.regexp_replace(c, pattern, f"{part('Y', '1900')}-{month}-{part('d', '1')} {part('H', '0')}:{part('M', '0')}:{part('S', '0')}.{part('f', '0')}")
    if "b" in names:
        name = F.lower(F.regexp_extract(c, pattern, names.index("b") + 1))
        iso = F.replace(iso, F.lit("@"), F.array_position(F.array(*(F.lit(m) for m in MONTHS)), name).cast("string"))
    return F.when(c.rlike(pattern), iso).try_cast("timestamp_ntz")


def parse_time(c: Column, formats: Sequence[str] = ISO, kind: T.DataType | None = None, on_bad: str = "null") -> Column:
    """The first format that fits a text gives its time, none gives null or, with ``on_bad`` fail, an error; ``kind`` is the
    column's type if it may be a date or time."""
    if on_bad not in ("null", "fail"):
        raise ValueError(f"on_bad is null or fail, not {on_bad!r}")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    text, readings, iso = c.cast("string"), [], []
    for form in [*formats, None]:
        if form is not None and _iso.fullmatch(form):
            iso.append(form)
            continue
        readings += [parse_iso(text, iso)] if iso else []
        iso = []
        readings += [parse_text(text, form)] if form is not None else []
    time = F.coalesce(*readings)
    if on_bad == "fail":
        message = F.concat(F.lit("no time in any of the formats: "), text)
        return F.when(text.isNotNull() & time.isNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(time)
    return time


def align_time(c: Column, formats: Sequence[str] = ISO, kind: T.DataType | None = None) -> Column:
    """A time as text of one form, with microseconds."""
    text = parse_time(c, formats, kind).cast("string")  # a format would go through the session's time zone
    return F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")


def date_text(c: Column, kind: T.DataType | None) -> Column:
    """The date part of a date or time column, or the text itself."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("date").cast("string")
    return F.trim(c.cast("string"))


def combine_date_time(date: Column, time: Column, formats: Sequence[str] = ISO[:2], kind: T.DataType | None = None) -> Column:
    """Date text and time text as one time; null if either is missing or both together fit no format."""
    return parse_time(F.concat(date_text(date, kind), F.lit(" "), F.trim(time.cast("string"))), formats)


def clock_part(c: Column) -> Column:
    """Hour or minute as two digits, cut toward zero; missing ones are 00, larger numbers keep their digits."""
    number = F.coalesce(to_number(c), F.lit(0.0))
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("bigint").cast("string")
    return F.when(F.length(whole) < 2, F.lpad(whole, 2, "0")).otherwise(whole)


def combine_parts(date: Column, hour: Column, minute: Column, formats: Sequence[str] = ("%Y-%m-%d",), kind: T.DataType | None = None) -> Column:
    """Date, hour and minute as one time; missing hours and minutes are 0, an hour of 24 or a negative one gives null."""
    day = parse_time(date_text(date, kind), formats).cast("date").cast("string")
    return parse_time(F.concat(day, F.lit(" "), clock_part(hour), F.lit(":"), clock_part(minute), F.lit(":00")), ("%Y-%m-%d %H:%M:%S",))
