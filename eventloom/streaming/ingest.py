"""Newly landed raw files through a compiled table description (ST1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.columns import named
from eventloom.operators.shape import require
from eventloom.plans.spec import TableSpec
from eventloom.plans.tables import compile_table
from eventloom.sources.readers import FORMATS, file_format
from eventloom.work import materialised


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal in all keys; missing ones are equal too."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"__{k}"]) for k in keys))


def first_seen(batch: DataFrame, earlier: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """One row of ``batch`` for each value of ``keys`` that no row of ``earlier`` has: of several, the smallest in its other columns.

    The earlier rows are cut down to keys of the batch by a semi-join, so that what meets the batch is no larger than it.
    """
    rest = [c for c in batch.columns if c not in keys]
    one = batch.groupBy(*map(named, keys)).agg(F.min(F.struct(*map(named, rest))).alias("__rest") if rest else F.count(F.lit(1)).alias("__rest"))
    one = one.select(*map(named, keys), *(F.col("__rest")[c].alias(c) for c in rest)).select(*map(named, batch.columns))
    if earlier is None:
        return one
    one = materialised(one)
    met = earlier.select(*(named(k).alias(f"__{k}") for k in keys))
    met = met.join(one, same_keys(one, met, keys), "left_semi").distinct()
    return one.join(met, same_keys(one, met, keys), "left_anti")


def written_rows(spark: SparkSession, target: str, but: int) -> DataFrame | None:
    """What other batches than ``but`` have written; None if nothing."""
    try:
        return spark.read.parquet(target).filter(F.col("batch") != but)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    state: str,
    file_format: str = "parquet",
    event_time: str | None = None,
    watermark: str = "7 days",
    keys: list[str] | None = None,
    files_per_batch: int | None = None,
    distinct_on: Sequence[str] | None = None,
    day_of: str | None = None,
    **options,
) -> StreamingQuery:
    """Start one pass over the files that landed since the last one; ``state`` remembers which were read.

    Each batch runs through ``transform`` (a batch plan, joins included) and is appended. The batch number is part of the
    path, so a batch that is run again after a failure replaces itself. With ``event_time`` rows that repeat an earlier
    one in ``keys`` are dropped within the watermark, across batches.

    ``distinct_on`` names columns of the transformed rows that no two written rows share, however far apart they landed: an
    anti-join with what other batches wrote leaves them out. With ``day_of``, a time among these columns, what is written is
    partitioned by ``day``, and a batch meets only the days that it holds. Other ``options`` are those of the reader.
    """
    options = options | ({"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {})
    if day_of and day_of not in (distinct_on or ()):
        raise ValueError("day_of is one of the columns that rows are distinct on, as equal rows are looked for within a day")
    stream = spark.readStream.schema(schema).options(**options).format(file_format).load(source)
    if event_time:
        stream = stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys or stream.columns)

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch)
        if distinct_on:
            require(rows, distinct_on)
            earlier = written_rows(rows.sparkSession, target, number)
            if day_of:
                rows = materialised(rows.withColumn("day", named(day_of).cast("date")))
                if earlier is not None:
                    days = [r[0] for r in rows.select("day").distinct().collect()]  # at most one a day of the calendar
                    earlier = earlier.filter(F.col("day").isin([d for d in days if d is not None]) | (F.col("day").isNull() if None in days else F.lit(False)))
            rows = first_seen(rows, earlier, distinct_on)
        writer = rows.write.mode("overwrite")
        (writer.partitionBy("day") if day_of else writer).parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def ingest_table(spark: SparkSession, spec: TableSpec, schema: T.StructType, target: str, state: str, id_map: DataFrame | None = None, day_of: str | None = None, files_per_batch: int | None = None) -> StreamingQuery:
    """``ingest`` of the files of a description, through its compiled plan. As a description without repeats asks, no two
    written rows are equal, whichever batches they came with (``dedupe`` off keeps all)."""
    file = spec.file
    kind = FORMATS.get(file.file_format, file.file_format) or file_format(file.path)
    options = {"header": True, "sep": file.sep, "encoding": file.encoding, "quote": file.quote, "escape": file.escape, "multiLine": file.multi_line} if kind == "csv" else {}

    def transform(batch: DataFrame) -> DataFrame:
        if kind == "csv" and file.null_words:
            batch = batch.select(*(F.when(~named(c).isin(*file.null_words), named(c)).alias(c) for c in batch.columns))
        return compile_table(spark, spec, id_map, raw=batch)

    columns = compile_table(spark, spec, id_map, raw=spark.createDataFrame([], schema)).columns
    return ingest(spark, file.path, schema, transform, target, state, kind, files_per_batch=files_per_batch, distinct_on=columns if spec.dedupe else None, day_of=day_of, **options)
