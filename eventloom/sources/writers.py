"""Sinks (S8-S11, S13): CSV and Parquet, overwriting or appending."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventloom.sources.readers import FORMATS

#: Rows of one output file at most.
FILE_ROWS = 20_000_000


def save(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite", skip_empty: bool = False, sep: str = ",", encoding: str = "UTF-8") -> int | None:
    """Write ``df`` and return its number of rows, counted while it is written; None if it is empty and skipped.

    Appending adds files. An empty table is written with its schema unless ``skip_empty``, which asks first.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode!r}")
    if skip_empty and df.isEmpty():
        return None
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("maxRecordsPerFile", FILE_ROWS)
    if FORMATS.get(file_format, file_format) == "csv":
        writer.options(header=True, sep=sep, encoding=encoding, escape='"').csv(path)
    else:
        writer.parquet(path)
    return seen.get["rows"]
