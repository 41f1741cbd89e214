"""Sources (S1-S5, S12): delimited text, gzipped or not, and Parquet, read with a column subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.errors import SpecError
from eventloom.functions.columns import named
from eventloom.operators.shape import require

FORMATS = {"csv": "csv", "asc": "csv", "parquet": "parquet"}


def file_format(path: str) -> str:
    name = path.rstrip("/").lower()
    name = name.removesuffix(".gz").removesuffix("/*")
    found = FORMATS.get(name.rpartition(".")[2])
    if not found:
        raise SpecError(f"{path}: the format is none of {', '.join(FORMATS)}; state it")
    return found


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    file_format_: str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    test_rows: int | None = None,
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = False,
    null_words: Sequence[str] = (),
    **options,
) -> DataFrame:
    """A raw table. Text columns of delimited files stay text: types come in by operators that say so.

    ``columns`` are checked and selected, so that Parquet reads no other. ``test_rows`` is a quick look at the first
    rows; leave it out for whole results. ``multi_line`` reads quoted fields with line breaks (a file is then one task).
    ``null_words``, such as NA, are missing values in delimited files; by default only the empty field is.
    """
    kind = FORMATS.get(file_format_, file_format_) or file_format(path)
    if kind == "csv":
        df = spark.read.options(header=True, sep=sep, encoding=encoding, quote=quote, escape=escape, multiLine=multi_line, **options).csv(path)
    else:
        df = spark.read.options(**options).parquet(path)
    if columns is not None:
        df = require(df, columns).select(*map(named, columns))
    if kind == "csv" and null_words:
        df = df.select(*(F.when(~named(c).isin(*null_words), named(c)).alias(c) for c in df.columns))
    return df.limit(test_rows) if test_rows else df
