"""Subject ids (A1, O1, F1, F3, S11): dense integers for text ids, and a map of them that grows with every load."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.errors import ConcurrentLoad
from eventloom.functions.columns import named
from eventloom.work import cleared, materialised

#: The smallest subject id; smaller numbers are free for padding and unknown subjects.
FIRST_ID = 2


def subject_ids(df: DataFrame, column: str, first: int = FIRST_ID) -> DataFrame:
    """(source_id, subject_id): dense numbers from ``first`` over the distinct ids in code point order; nulls have none.

    The ids are dealt by range, so that each partition is one stretch of the order. Counts per partition (one row each)
    give every stretch its first number, and ids are numbered within their partition: no task sees all ids.
    """
    ids = df.select(named(column).cast("string").alias("source_id")).filter("source_id is not null").distinct()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialised(ids.repartitionByRange(n, "source_id").withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("source_id"))
    # one row a partition, so its size is bounded by the number of partitions
    return dealt.join(F.broadcast(offsets), "part").select("source_id", (F.col("offset") + within + (first - 1)).alias("subject_id"))


def map_subjects(df: DataFrame, id_map: DataFrame, column: str = "subject_id") -> DataFrame:
    """Only rows of known subjects, the text id replaced by its number."""
    ids = id_map.select(F.col("source_id").alias("__source"), F.col("subject_id").alias("__subject"))
    joined = df.join(ids, named(column).cast("string") == F.col("__source"))
    return joined.select(*(F.col("__subject").alias(c) if c == column else named(c) for c in df.columns))


def known_patients(df: DataFrame, column: str = "subject_id") -> DataFrame:
    return df.dropna(subset=[column])


def read_id_map(spark: SparkSession, path: str) -> DataFrame | None:
    """(source_id, subject_id, version) of a map that ``extend_id_map`` keeps; None if there is none yet."""
    try:
        return spark.read.schema("source_id string, subject_id bigint, writer string, version int").parquet(path).drop("writer")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def extend_id_map(ids: DataFrame, column: str, path: str, first: int = FIRST_ID) -> DataFrame:
    """The map at ``path`` with the ids of ``column`` that it lacked; numbers once given never change.

    New ids are those that an anti-join leaves over; they are numbered as ``subject_ids`` does, from the largest number of
    the map on, and added as the map's next version, a folder of their own. Without new ids there is no new version. A load
    that finds its version taken, or written by another one at the same time, fails with ConcurrentLoad and has changed no
    number: the map is to be extended by one load after the other.
    """
    spark = ids.sparkSession
    with cleared(spark):
        added_version(ids, column, path, first)
    return read_id_map(spark, path)


def added_version(ids: DataFrame, column: str, path: str, first: int) -> None:
    """Numbers new ids and adds them to the map as its next version."""
    spark = ids.sparkSession
    new = ids.select(named(column).cast("string").alias("source_id")).filter("source_id is not null").distinct()
    known, version, start = read_id_map(spark, path), 1, first
    if known is not None:
        new = materialised(new.join(known.select("source_id"), "source_id", "left_anti"))
        if new.isEmpty():
            return
        last = known.agg(F.max("version"), F.max("subject_id")).first()
        version, start = (last[0] or 0) + 1, first if last[1] is None else last[1] + 1
    writer, target = uuid.uuid4().hex, f"{path}/version={version}"
    try:
        subject_ids(new, "source_id", start).withColumn("writer", F.lit(writer)).write.mode("errorifexists").parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise ConcurrentLoad(f"{target} is there already: another load extends the map, or one has failed and left it") from error
    if not spark.read.parquet(target).filter(F.col("writer") != writer).isEmpty():
        raise ConcurrentLoad(f"{target} was written by two loads at once: remove it and load again")
