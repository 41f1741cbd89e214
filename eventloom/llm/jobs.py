"""What several operators share: tables cut from their lineage, bounded draws, batches of bounded bytes."""

from __future__ import annotations

import itertools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Text that is looked at at once, unless one text alone is longer.
PIECE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only on one machine, where it may be unset, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    return os.path.join(tempfile.gettempdir(), "eventloom")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: later reads don't run its plan again, lost executors take nothing along."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/eventloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, column: int = 1, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts in ``column`` have at most ``limit`` bytes, or that are one row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right"))
        end = max(end, at + 1)
        yield batch.slice(at, end - at)
        at = end


SPACE = 1 << 62


def share(of, bound: int, total: int):
    """Whether a row lies in the share of the hash space of the columns ``of`` that about ``bound`` of ``total`` lie in."""
    limit = SPACE if total <= bound else SPACE * bound // total
    return F.pmod(F.xxhash64(*of, F.lit(17)), F.lit(SPACE)) < F.lit(limit)


def drawn(rows: DataFrame, bound: int, read: Callable[[pa.RecordBatch], list[pa.Array]] | None = None, schema: str = "") -> list[Row]:
    """At most ``bound`` different rows, drawn by a hash of their whole content, in the order of that hash.

    Spark does the drawing: a share of the hash space that holds about ``bound`` rows, without repeated rows, of which
    the first ``bound`` reach the driver. The same rows give the same draw, however they are spread. With ``read`` the
    texts stay on the tasks: it turns a batch of rows (the last column their text) to columns of ``schema``, a row for
    each, and these reach the driver instead.
    """
    some = rows.filter(share(rows.columns, bound, rows.count())).distinct()
    some = some.withColumn("__h", F.pmod(F.xxhash64(*rows.columns, F.lit(17)), F.lit(SPACE)))
    if read:
        text = len(rows.columns) - 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in itertools.chain.from_iterable(pieces(b, text) for b in batches):
                columns = [*read(part), part.column(text + 1)]
                yield pa.RecordBatch.from_arrays(columns, names)

        names = [c.split()[0] for c in schema.split(", ")] + ["__h"]
        some = some.mapInArrow(run, f"{schema}, __h bigint")
    return some.orderBy("__h", *[c for c in some.columns if c != "__h"]).limit(bound).drop("__h").collect()
