"""A written cohort by size (S14, M10): files of about as many events each, every subject in one file, and new events
merged into the files that they concern.

Subject ids are cut into slices of equal width. Events per slice are counted first; neighbouring slices are packed into
shards of a wanted number of events. A shard is a file, or several if it has more events than one task should sort. The
slices with their shards are the manifest, beside the cohort's folder: it says which files new events belong to, so that a
merge reads and writes no other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.operators.shape import require
from eventloom.work import cleared, materialised

#: Slices of the range of ids, for each split: what is sent to all tasks is one row of some 30 bytes for each.
MAX_SLICES = 1 << 18
#: Events of one shard.
FILE_ROWS = 20_000_000
#: Larger shards are cut into pieces of at most so many events (and those of a slice); a task sorts and writes at most twice as many.
TASK_ROWS = 1_000_000
EVENT = ("subject_id", "time", "code", "numeric_value")


def manifest_path(path: str) -> str:
    return path.rstrip("/") + ".manifest"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(split, slice, n, shard, first, width, rows_per_file) of the cohort at ``path``."""
    return spark.read.parquet(manifest_path(path))


def read_cohort(spark: SparkSession, path: str, *folders: str) -> DataFrame:
    """The cohort at ``path``, or these of its folders, listed by a few tasks a core: Spark takes up to 10,000 a split."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.option("basePath", path).parquet(*(folders or [path]))
    finally:
        spark.conf.set(name, before)


def slice_of(subject: Column, first: int, width: int) -> Column:
    return F.floor((subject - F.lit(first)) / F.lit(width)).cast("bigint")


def packed(slices: DataFrame, rows_per_file: int) -> DataFrame:
    """(split, slice, n, shard) of ``slices`` (split, slice, n, last: the split's largest shard or -1): in their order they are cut
    into new shards of equal shares, of at most ``rows_per_file`` events each but for the slice at the border."""
    split = Window.partitionBy("split")
    before = F.coalesce(F.sum("n").over(split.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = F.ceil(F.sum("n").over(split) / F.lit(rows_per_file))
    out = slices.withColumns({"part": F.floor(before * shards / F.sum("n").over(split))})
    number = F.dense_rank().over(split.orderBy("part"))  # a large slice may leave out a part
    return out.select("split", "slice", "n", (F.col("last") + number).cast("int").alias("shard"))


def dealt_pieces(slices: DataFrame, tasks: int | None = None) -> DataFrame:
    """(split, slice, shard, place) of ``slices`` (split, slice, n, shard): the task that writes each slice.

    Shards of more than ``TASK_ROWS`` events are cut into pieces of equal shares. Pieces go to tasks in their order, so many
    to one as make up an equal share of all events or ``TASK_ROWS``: the tasks grow with the events, not with the files.
    With ``tasks``, pieces go round so many instead.
    """
    shard = Window.partitionBy("split", "shard")
    preceding = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = F.sum("n").over(shard)
    cut = slices.withColumn("piece", F.floor(preceding(shard.orderBy("slice")) * F.ceil(size / F.lit(TASK_ROWS)) / size))
    order = Window.orderBy("split", "shard", "piece")  # one row a file
    pieces = cut.groupBy("split", "shard", "piece").agg(F.sum("n").alias("n"))
    if tasks:
        placed = pieces.withColumn("place", (F.row_number().over(order) - 1) % tasks)
    else:
        n = slices.agg(F.sum("n")).first()[0] or 0
        share = max(1, min(TASK_ROWS, math.ceil(n / slices.sparkSession.sparkContext.defaultParallelism)))
        # a large piece may leave out a share
        placed = pieces.withColumn("share", F.floor(preceding(order) / F.lit(share))).withColumn("place", F.dense_rank().over(Window.orderBy("share")) - 1)
    return cut.join(placed.select("split", "shard", "piece", "place"), ["split", "shard", "piece"]).select("split", "slice", "shard", "place")


def write_shards(events_: DataFrame, slices: DataFrame, path: str, first: int, width: int, only: bool, tasks: int | None = None) -> None:
    """Events (with split) by split and shard, ordered by subject and time; ``only`` these shards are replaced, or the cohort."""
    places = materialised(dealt_pieces(slices, tasks))
    n = (places.agg(F.max("place")).first()[0] or 0) + 1
    of = F.broadcast(places)  # one row a slice: MAX_SLICES of a split at most
    placed = events_.withColumn("slice", slice_of(F.col("subject_id"), first, width)).join(of, ["split", "slice"])
    dealt = placed.repartitionById(n, "place") if n > 1 else placed.repartition(1)
    ordered = dealt.sortWithinPartitions("split", "shard", "subject_id", F.col("time").asc_nulls_first(), "code").select(*events_.columns, "shard")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only else "static").partitionBy("split", "shard").parquet(path)


def dealt_by_subject(events_: DataFrame, rows: int) -> DataFrame:
    """Events dealt by subject over so many tasks as ``rows`` of them need: what is then asked by subject, repeats of rows
    included, is shuffled no more, and no task gathers rows before the shuffle."""
    return events_.repartition(tasks_for(events_.sparkSession, rows), "subject_id")


def tasks_for(spark: SparkSession, rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def write_cohort(events_: DataFrame, splits: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite", rows_per_file: int = FILE_ROWS) -> None:
    """Events of the subjects in ``splits`` as Parquet by split and shard, and the manifest beside it.

    All events of a subject lie in one file, by subject and time; shards of a split differ by less than two of its slices,
    unless one subject alone has more events. A shard is one file up to ``TASK_ROWS`` events, else several in the order of
    subjects. ``partitions`` asks for about so many shards, written by so many tasks, instead of ``rows_per_file`` events each. Events are counted before they are dealt, so they are written to an
    intermediate table first, which is emptied at the end. Without events there are no files.
    """
    if mode != "overwrite":
        raise ValueError("a cohort is written whole; merge_cohort adds events to one")
    with cleared(events_.sparkSession):
        whole = materialised(require(events_, ["subject_id", "time", "code"]).join(splits.select("subject_id", "split"), "subject_id"))
        seen = whole.agg(F.min("subject_id"), F.max("subject_id"), F.count("*")).first()
        first, n = seen[0] or 0, seen[2]
        width = max(1, math.ceil(((seen[1] or 0) - first + 1) / MAX_SLICES))
        rows_per_file = max(1, math.ceil(n / partitions)) if partitions else rows_per_file
        counts = whole.groupBy("split", slice_of(F.col("subject_id"), first, width).alias("slice")).agg(F.count("*").alias("n"))
        slices = materialised(packed(counts.withColumn("last", F.lit(-1)), rows_per_file))
        write_shards(whole, slices, path, first, width, only=False, tasks=partitions)
        described(slices, first, width, rows_per_file).write.mode("overwrite").parquet(manifest_path(path))


def described(slices: DataFrame, first: int, width: int, rows_per_file: int) -> DataFrame:
    return slices.select("split", "slice", "n", "shard", F.lit(first).cast("bigint").alias("first"), F.lit(width).cast("bigint").alias("width"), F.lit(rows_per_file).cast("bigint").alias("rows_per_file"))


def merge_cohort(new: DataFrame, splits: DataFrame, path: str, dedupe: bool = True) -> int:
    """Add events to a written cohort; the number of its shards that were replaced or made.

    The manifest tells the shards of the new events; slices that it lacks are packed into new shards. Only files of touched
    shards are read, and each is replaced when the write commits. The events are those that one load of all would give;
    with ``dedupe`` repeated ones are one, so that a merge that failed half-way can be run again. Shards grow with what is
    merged into them, and are never cut: write the cohort anew when its manifest shows some that are too large.
    """
    spark = new.sparkSession
    with cleared(spark):
        manifest = materialised(read_manifest(spark, path))
        of = manifest.first()
        if of is None:
            raise ValueError(f"the cohort in {path} has no events: write it whole")
        first, width, rows_per_file = of["first"], of["width"], of["rows_per_file"]
        folder = lambda r: f"{path}/split={r['split']}/shard={r['shard']}"
        known, columns = manifest.select("split", "slice", "shard"), [c for c in read_cohort(spark, path, folder(of)).columns if c != "shard"]
        in_slice = slice_of(F.col("subject_id"), first, width).alias("slice")
        fresh = materialised(new.join(splits.select("subject_id", "split"), "subject_id").select(*columns))
        # bounded by the number of the cohort's files
        touched = fresh.select("split", in_slice).distinct().join(known, ["split", "slice"]).select("split", "shard").distinct().collect()
        every = len(touched) == known.select("split", "shard").distinct().count()
        paths = [path] if every else [folder(r) for r in touched]
        merged = read_cohort(spark, path, *paths).select(*columns).unionByName(fresh) if paths else fresh
        rows = fresh.count() + (manifest.agg(F.sum("n")).first()[0] if paths else 0)
        merged = materialised(dealt_by_subject(merged, rows).dropDuplicates() if dedupe else merged)
        counts = merged.groupBy("split", in_slice).agg(F.count("*").alias("n")).join(known, ["split", "slice"], "left")
        last = manifest.groupBy("split").agg(F.max("shard").alias("last"))
        added = counts.filter("shard is null").join(last, "split", "left").select("split", "slice", "n", F.coalesce("last", F.lit(-1)).alias("last"))
        slices = materialised(counts.filter("shard is not null").select("split", "slice", "n", "shard").unionByName(packed(added, rows_per_file)))
        write_shards(merged, slices, path, first, width, only=True)
        rest = manifest.join(slices, ["split", "slice"], "left_anti").select("split", "slice", "n", "shard")
        described(rest.unionByName(slices), first, width, rows_per_file).write.mode("overwrite").parquet(manifest_path(path))
        return slices.select("split", "shard").distinct().count()
