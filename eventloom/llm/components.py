"""Connected components of a graph given as a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Each vertex hands its smallest neighbour (or itself) to its larger neighbours, or to its smaller ones and itself."""
    if larger:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex hangs on one smaller vertex only, and that one on none: then no step changes anything."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs")).unionAll(edges.select(F.col("v").alias("id"), F.lit(None).cast("int").alias("hangs")))
    degrees = ends.groupBy("id").agg(F.count("hangs").alias("up"), F.count("*").alias("all"))
    return not degrees.agg(F.max((F.col("up") > 1) | (F.col("up") == 1) & (F.col("all") > 1))).first()[0]


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, component): the smallest id that each vertex of ``edges`` (u, v) reaches; ids without an edge are left out.

    The edges turn into stars round their smallest vertex; each round is cut from its lineage. With ``rounds`` the
    result may still be too fine, never too coarse. Edges that are such stars already take no round.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    now = written(pairs.groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one"))
    done = 0
    while (rounds is None or done < rounds) and not _are_stars(now):
        now = written(_star(_star(now, True), False))
        done += 1
    labels = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = now.groupBy(F.col("v").alias("id")).agg(F.min("v").alias("component"))
    return labels.unionAll(roots.join(labels, "id", "left_anti"))
