"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only on one machine, where it may be unset, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    return folder or os.path.join(tempfile.gettempdir(), "eventloom-work")


_open = threading.local()


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written as a table and read again, so that lost executors and repeated reads cost no second run."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Empties the tables that ``materialised`` writes within, in the same thread, when the block ends: for steps whose own
    results are written by then. Overwriting a table with none of its rows removes its files wherever the folder lies."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        made, _open.paths = _open.paths, outer
        for path in made:
            spark.range(0).write.mode("overwrite").parquet(path)
