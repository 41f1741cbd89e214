"""Repairs of one column: Column in, Column out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a number in a text; a bare cast would also take suffixes such as 1.0f and 5d.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
#: A whole number written as digits, with or without an empty fraction.
DIGITS = r"^\s*\+?(-?\d+)(?:\.0*)?\s*$"
#: Whole numbers beyond it do not fit a bigint.
LARGEST_WHOLE = 9.2e18


def named(name: str) -> Column:
    """A column by its plain name, which may hold dots, blanks and any letter."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_number(c: Column) -> Column:
    """A text as double; null where it is no number (P7). Numeric columns pass by a cast."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def strip_zeros(c: Column) -> Column:
    """Digits without leading zeros, as text: '01' and '1.0' give '1'; null where the value is no whole number.

    Digits are read as they stand, so that ids of up to 19 digits keep every one; only other forms, such as 1e3, go
    through a floating point number. Numbers beyond a bigint are null.
    """
    text, number = c.cast("string"), to_number(c)
    whole = (F.floor(number).cast("double") == number) & (F.abs(number) < LARGEST_WHOLE)
    other = F.when(F.abs(number) < LARGEST_WHOLE, F.when(whole, number.cast("bigint").cast("string")))
    return F.when(text.rlike(DIGITS), F.regexp_extract(text, DIGITS, 1).try_cast("bigint").cast("string")).otherwise(other)


def from_value_map(c: Column, values: Mapping[str, str]) -> Column:
    """The mapped value; null where the map has no such key (P4). For a map that grows with the data, join a lookup."""
    if not values:
        return F.lit(None).cast("string")
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[c.cast("string")]


def pad_suffix(c: Column, suffix: str, unless_contains: str | None = None) -> Column:
    """The text with a suffix, unless it holds ``unless_contains`` (by default the suffix itself); null stays (P5)."""
    mark = suffix if unless_contains is None else unless_contains
    return F.when(c.isNotNull() & ~c.contains(mark), F.concat(c, F.lit(suffix))).otherwise(c)


def prefixed(c: Column, prefix: str, null_literal: str | None = None) -> Column:
    """The text behind a prefix (P6). Null stays null; ``null_literal`` puts that word in its place instead."""
    text = c.cast("string")
    return F.concat(F.lit(prefix), F.coalesce(text, F.lit(null_literal)) if null_literal is not None else text)


def fill_from_regex(target: Column, filler: Column, pattern: str) -> Column:
    """Nulls of ``target`` from the first group of ``pattern`` in ``filler``; no match leaves the null."""
    return F.coalesce(target, F.when(filler.rlike(pattern), F.regexp_extract(filler, pattern, 1)))


def fill_literal(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def gestation_days(c: Column) -> Column:
    """Gestational age 'W D/7' in days; null where the text has another form (Q6)."""
    pattern = r"^\s*(\d{1,2})\s+([0-6])/7\s*$"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1).try_cast("int") * 7 + F.regexp_extract(c, pattern, 2).try_cast("int"))


def week_start(c: Column, century: int = 2000) -> Column:
    """Monday of a week stamp YYWW, week 1 being the one that holds 4 January; null for other texts and weeks (Q6)."""
    pattern = r"^(\d{2})(\d{2})$"
    ok = c.rlike(pattern)
    year = F.when(ok, F.substring(c, 1, 2).try_cast("int") + century)
    week = F.when(ok, F.substring(c, 3, 2).try_cast("int"))
    january = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(january, F.weekday(january))
    return F.when((week >= 1) & (week <= 53), F.date_add(monday, (week - 1) * 7))
