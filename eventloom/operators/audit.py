"""Audits of raw tables (Q1-Q5): pseudonyms, link coverage, defects, order of times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import named, to_number


def pseudonymise(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """The column as the SHA-256 of salt and text, in hex; null stays."""
    return df.withColumn(column, F.sha2(F.concat(F.lit(salt), named(column).cast("string")), 256))


def link_coverage(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """One row: child rows, orphans (rows without a parent), null keys, parent keys, unused parent keys, largest fan-out.

    Both sides are counted per key before they meet, so a frequent key is one row in the join.
    """
    c = child.groupBy(named(child_key).alias("k")).agg(F.count("*").alias("rows"))
    p = parent.select(named(parent_key).alias("p")).filter("p is not null").distinct()
    both = c.join(p, F.col("k") == F.col("p"), "outer")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    return both.agg(
        F.sum(rows).alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNotNull() & F.col("p").isNull(), rows)), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull() & F.col("p").isNull(), rows)), F.lit(0)).alias("null_key_rows"),
        F.count("p").alias("parent_keys"),
        F.count_if(F.col("p").isNotNull() & F.col("k").isNull()).alias("unused_parent_keys"),
        F.coalesce(F.max(F.when(F.col("p").isNotNull(), rows)), F.lit(0)).alias("largest_fan_out"),
    )


def repeated_links(df: DataFrame, key: str) -> DataFrame:
    """(key, uses) of parents that are used more than once."""
    return df.filter(named(key).isNotNull()).groupBy(named(key).alias("key")).agg(F.count("*").alias("uses")).filter("uses > 1")


def defect_profile(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (), ids: Sequence[str] = ()) -> DataFrame:
    """One row a column: rows, nulls, all_null_rows (of the table), non_numeric (for numeric columns), truncated (ids of
    another length than the most frequent one). One pass for the counts, one for the lengths."""
    empty = F.count_if(F.forall(F.array(*(named(c).isNull() for c in columns)), lambda x: x))
    stats = [F.count("*").alias("rows"), empty.alias("empty")]
    for i, c in enumerate(columns):
        stats.append(F.count_if(named(c).isNull()).alias(f"nulls_{i}"))
        stats.append((F.count_if(named(c).isNotNull() & to_number(named(c)).isNull()) if c in numeric else F.lit(None).cast("bigint")).alias(f"words_{i}"))
    counts = df.agg(*stats)
    row = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"nulls_{i}").alias("nulls"), F.col(f"words_{i}").alias("non_numeric")) for i, c in enumerate(columns)))).alias("x")
    out = counts.select("rows", F.col("empty").alias("all_null_rows"), row).select("x.column", "rows", "x.nulls", "all_null_rows", "x.non_numeric")
    if not ids:
        return out.withColumn("truncated", F.lit(None).cast("bigint"))
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.length(named(c).cast("string")).alias("n")) for c in ids))).alias("x")).select("x.*").filter("n is not null")
    lengths = long.groupBy("column", "n").agg(F.count("*").alias("rows"))
    mode = lengths.groupBy("column").agg(F.max(F.struct("rows", "n")).alias("m"), F.sum("rows").alias("all"))
    return out.join(mode.select("column", (F.col("all") - F.col("m.rows")).alias("truncated")), "column", "left")


def out_of_order(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose end lies before their start."""
    return df.filter(named(end) < named(start))
