"""Projection, reshaping, cleaning and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.errors import MissingColumns
from eventloom.functions.columns import fill_from_regex, named, prefixed

MANDATORY = ("subject_id", "code", "timestamp")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(missing, df.columns)
    return df


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the columns of ``names``, in its order and under its new names."""
    require(df, list(names))
    return df.select(*(named(k).alias(v) for k, v in names.items()))


def fill_nulls(df: DataFrame, target: str, source: str | None = None, pattern: str | None = None, value=None, drop: bool = True) -> DataFrame:
    """Nulls of ``target`` from another column, from a pattern's group in it, or from a literal. The source column goes."""
    if source is None:
        return df.withColumn(target, F.coalesce(named(target), F.lit(value)))
    require(df, [target, source])
    filled = fill_from_regex(named(target), named(source), pattern) if pattern else F.coalesce(named(target), named(source))
    out = df.withColumn(target, filled)
    return out.drop(source) if drop and source != target else out


def melt(df: DataFrame, columns: Mapping[str, str], into: str, prefix_column: str | None = None, null_literal: str | None = None) -> DataFrame:
    """Each of ``columns`` (column -> prefix) becomes a row with its value in ``into``; rows of null values stay.

    ``prefix_column`` gets the prefix of the column that the row came from. One pass over the input.
    """
    require(df, list(columns))
    ids = [c for c in df.columns if c not in columns]
    long = df.unpivot([named(c) for c in ids], [named(c) for c in columns], "__source", into)
    if prefix_column:
        prefix = F.create_map(*(F.lit(x) for pair in columns.items() for x in pair))[F.col("__source")]
        text = named(prefix_column).cast("string")
        text = F.coalesce(text, F.lit(null_literal)) if null_literal is not None else text
        long = long.withColumn(prefix_column, F.concat(prefix, text))
    return long.drop("__source")


def melt_chain(df: DataFrame, steps: Sequence[Mapping]) -> DataFrame:
    return reduce(lambda d, step: melt(d, **step), steps, df)


def unroll(df: DataFrame, columns: Mapping[str, str], keep_code: bool = False, null_literal: str | None = None) -> DataFrame:
    """Each listed column (column -> prefix) becomes rows of subject_id, timestamp, code; missing columns are skipped.

    ``keep_code`` adds the rows of code itself. Without any listed column the table passes unchanged. One pass: an
    array of codes per row is exploded, not one union for each column.
    """
    present = {c: p for c, p in columns.items() if c in df.columns}
    if not present:
        return df
    codes = [prefixed(named(c), p, null_literal) for c, p in present.items()]
    if keep_code and "code" in df.columns and "code" not in present:
        codes.append(F.col("code").cast("string"))
    keys = [c for c in ("subject_id", "timestamp") if c in df.columns]
    return df.select(*keys, F.explode(F.array(*codes)).alias("code"))


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_incomplete(df: DataFrame, mandatory: Sequence[str] = MANDATORY) -> DataFrame:
    """Rows without a null in a mandatory column, if the table has all of these columns; else the table itself."""
    return df.dropna(subset=list(mandatory)) if all(c in df.columns for c in mandatory) else df


def drop_repeats(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
