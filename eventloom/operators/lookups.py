"""Lookup joins (J1-J9): columns of a side table by a key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import named
from eventloom.operators.shape import require

HOW = ("inner", "left", "right", "outer", "full")


def heavy_keys(keys: DataFrame, salts: int) -> list:
    """Keys (``__key``) of more than a salt's share of all rows, so fewer than ``salts`` of them. Counts are combined before they
    are shuffled; nulls, which match nothing, are no keys."""
    counts = keys.groupBy("__key").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.filter(F.col("__key").isNotNull() & (F.col("n") * salts > total)).select("__key").collect()]


def lookup(
    df: DataFrame,
    side: DataFrame,
    on: str,
    key: str,
    targets: Mapping[str, str],
    how: str = "inner",
    drop_source: bool = False,
    null_keys_match: bool = False,
    dedupe: bool = False,
    salts: int = 0,
) -> DataFrame:
    """``targets`` (side column -> new name) of the rows of ``side`` whose ``key`` equals ``on``.

    Keys of different type meet as text. Null keys match nothing unless ``null_keys_match``. A key that the side has
    several times multiplies rows; ``dedupe`` keeps one side row a key (the smallest). ``on`` goes with
    ``drop_source``; on unmatched rows of a right or full join it is null. The join's strategy is left to the
    planner, which knows the side's size.

    ``salts`` deals rows of null keys and of keys with many rows over so many tasks each, for tables in which one key or
    none at all stands in a large part of the rows: side rows of such keys are copied as often. Rows are the same. Keys
    are counted first, which reads the table's key column once more; only inner and left lookups can be salted.
    """
    if how not in HOW:
        raise ValueError(f"how is one of {', '.join(HOW)}, not {how!r}")
    require(df, [on])
    require(side, [key, *targets])
    names = {source: f"__side_{i}" for i, source in enumerate(targets)}
    side = side.select(named(key).alias("__key"), *(named(s).alias(n) for s, n in names.items()))
    if dedupe:
        side = side.groupBy("__key").agg(F.min(F.struct(*names.values())).alias("s")).select("__key", "s.*")
    left, right = named(on), F.col("__key")
    if df.schema[on].dataType != side.schema["__key"].dataType:
        left, right = left.cast("string"), right.cast("string")
    match = left.eqNullSafe(right) if null_keys_match else left == right
    if salts > 1:
        if how not in ("inner", "left") or null_keys_match:
            raise ValueError("only inner and left lookups in which null keys match nothing can be salted")
        heavy = heavy_keys(df.select(left.alias("__key")), salts)
        df = df.withColumn("__salt", F.when(left.isNull() | left.isin(heavy), F.pmod(F.xxhash64(*map(named, df.columns)), F.lit(salts))).otherwise(F.lit(0)))
        copies = F.when(right.isin(heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        side = side.withColumn("__side_salt", F.explode(copies.cast("array<bigint>")))
        match = match & (F.col("__salt") == F.col("__side_salt"))
    out = df.join(side, match, {"full": "outer"}.get(how, how))
    kept = [c for c in df.columns if c not in (*targets.values(), "__salt") and not (drop_source and c == on)]
    return out.select(*(named(c) for c in kept), *(F.col(names[s]).alias(n) for s, n in targets.items()))
