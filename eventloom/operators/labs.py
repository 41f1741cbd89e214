"""Lab normalisation (A3-A7, N1-N7, F4, P16): per-code statistics, fitted on one table and applied to any.

``fit`` returns a small table of one row a code; ``apply`` joins it. Numbers go to ``numeric_value``, labels to
``value_label``: a quantile, UNIQUE for a code with one value, N/A for an unknown or null code, or the original text
where the value is no number.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.errors import SpecError
from eventloom.functions.columns import named, to_number
from eventloom.operators.shape import require, stack
from eventloom.work import materialised

METHODS = ("minmax", "quantile", "category")
LOW, HIGH = 0.01, 0.99
#: Different values of one code that one task sorts.
TASK_VALUES = 2_000_000
#: Size of a sketch: the larger, the closer its ranks.
SKETCH_K = 800


def cut_points(method: str, n: int = 10) -> list[float]:
    if method == "minmax":
        return [LOW, HIGH]
    if method == "category":
        return [0.25, 0.5, 0.75]
    if method == "quantile":
        if n < 1:
            raise ValueError("a quantile normalisation needs at least one quantile")
        return [i / n for i in range(1, n + 1)]
    raise ValueError(f"method is one of {', '.join(METHODS)}, not {method!r}")


def numeric_values(df: DataFrame, code: str, value: str) -> DataFrame:
    """(code, v) of rows that have a code and a number."""
    require(df, [code, value])
    return df.select(named(code).alias("code"), to_number(named(value)).alias("v")).filter("code is not null and v is not null")


def counted_values(values: DataFrame) -> DataFrame:
    """(code, v, n): equal values of a code are counted before anything is dealt by code."""
    return values.groupBy("code", "v").agg(F.count("*").alias("n"))


def percentiles(counted: DataFrame, points: list[float]) -> DataFrame:
    """Exact percentiles per code, linear between neighbours; a code's different values come together in one task."""
    return counted.groupBy("code").agg(F.percentile("v", F.array(*map(F.lit, points)), F.col("n")).alias("cuts"))


def percentiles_sorted(counted: DataFrame, points: list[float]) -> DataFrame:
    """The same for codes with too many different values for one task: they are sorted by range over (code, v) and ranked
    through per-partition sums, then only the two neighbours of each point are picked out."""
    n = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialised(counted.repartitionByRange(n, "code", "v").withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("code", "part").agg(F.sum("n").alias("n"))
    per_code = Window.partitionBy("code")
    before = per_code.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("code", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(per_code).alias("total"))
    within = Window.partitionBy("code", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.withColumn("upto", F.sum("n").over(within)).join(offsets, ["code", "part"]).withColumn("last", F.col("offset") + F.col("upto") - 1)
    points_at = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(points)))
    at = F.col("q.p") * (F.col("total") - 1)
    holds = lambda rank: (rank <= F.col("last")) & (rank > F.col("last") - F.col("n"))
    picked = ranked.select("code", "v", "n", "last", "total", F.explode(points_at).alias("q")).filter(holds(F.floor(at)) | holds(F.ceil(at)))
    each = picked.groupBy("code", "q.i").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.first(at - F.floor(at)).alias("share"))
    # written as low + (high - low) * share would be, term by term, in the built-in percentile
    each = each.withColumn("cut", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise((1 - F.col("share")) * F.col("lo") + F.col("share") * F.col("hi")))
    return each.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cut"))), lambda x: x["cut"]).alias("cuts"))


def fit(df: DataFrame, method: str = "minmax", n: int = 10, code: str = "code", value: str = "numeric_value", how: str = "auto", accuracy: int = 10_000) -> DataFrame:
    """(code, cuts): cut points of every code with a number.

    ``how``: exact (a code's different values in one task), sorted (the same numbers, a code spread over tasks), auto
    (sorted if a code has more than TASK_VALUES different values) or approx.
    """
    values, points = numeric_values(df, code, value), cut_points(method, n)
    if how == "approx":
        return values.groupBy("code").agg(F.percentile_approx("v", points, accuracy).alias("cuts"))
    if how not in ("auto", "sorted", "exact"):
        raise ValueError(f"how is auto, exact, sorted or approx, not {how!r}")
    counted = counted_values(values)
    if how == "auto":
        # counted values are written, as they are read again; codes are only looked at if all together exceed one task
        seen = Observation()
        counted = materialised(counted.observe(seen, F.count(F.lit(1)).alias("rows")))
        hot = seen.get["rows"] > TASK_VALUES and not counted.groupBy("code").count().filter(F.col("count") > TASK_VALUES).isEmpty()
        how = "sorted" if hot else "exact"
    return (percentiles_sorted if how == "sorted" else percentiles)(counted, points)


def sketches(df: DataFrame, code: str = "code", value: str = "numeric_value", k: int = SKETCH_K) -> DataFrame:
    """(code, sketch): a quantile sketch of each code's numbers, of a size that ``k`` bounds whatever their number.

    Sketches of several loads can be saved and merged, so that statistics follow new data without reading the old. A rank
    that a sketch gives is within about 2.3 / k ** 0.9 of the true one (k = 800: 0.6 percent), with 99 percent confidence.
    """
    return numeric_values(df, code, value).groupBy("code").agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """Sketches of the numbers of all parts together."""
    return stack(*parts).groupBy("code").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def fit_sketches(sketched: DataFrame, method: str = "minmax", n: int = 10) -> DataFrame:
    """(code, cuts, n_values): cut points from sketches, for ``apply`` and ``save_statistics``; they are values that occur."""
    points = F.array(*map(F.lit, cut_points(method, n)))
    return sketched.select("code", F.kll_sketch_get_quantile_double("sketch", points).alias("cuts"), F.kll_sketch_get_n_double("sketch").alias("n_values"))


def quantile_label(v: Column, cuts: Column, points: int, labels: int) -> Column:
    """Q1 for values up to the first of ``points`` cut points, and so on; above all of them the last label."""
    out = F.when(v <= cuts[0], "Q1")
    for i in range(1, points):
        out = out.when(v <= cuts[i], f"Q{i + 1}")
    return out.when(v.isNotNull() & cuts.isNotNull(), f"Q{labels}")


def apply(df: DataFrame, stats: DataFrame, method: str = "minmax", n: int = 10, code: str = "code", value: str = "numeric_value", single_column: bool = False) -> DataFrame:
    """``df`` with normalised ``value`` and a ``value_label``; ``single_column`` puts both into ``value`` as text."""
    points = cut_points(method, n)
    require(df, [code, value])
    stats = stats.select(F.col("code").alias("__code"), F.col("cuts").alias("__cuts"))
    joined = df.join(stats, named(code) == F.col("__code"), "left")
    text, v, cuts = named(value).cast("string"), to_number(named(value)), F.col("__cuts")
    text = F.when(F.lower(F.trim(text)) != "nan", text)  # not a number, however written, is a missing value and no label
    unknown = F.when(cuts.isNull(), F.lit("N/A"))
    if method == "minmax":
        low, high = cuts[0], cuts[1]
        scaled = F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - low) / F.nullif(high - low, F.lit(0.0)))), 3)
        number = F.when(v.isNotNull() & cuts.isNotNull() & (low != high), scaled)
        label = F.when(v.isNull(), text).otherwise(F.coalesce(unknown, F.when(low == high, F.lit("UNIQUE"))))
    else:
        number = F.lit(None).cast("double")
        label = F.when(v.isNull(), text).otherwise(F.coalesce(unknown, quantile_label(v, cuts, len(points), len(points) + (method == "category"))))
    rest = [c for c in df.columns if c not in (value, "value_label")]
    if single_column:
        return joined.select(*map(named, rest), F.coalesce(label, number.cast("string")).alias(value))
    # the label stands before the number: within its lambda, the number's alias would hide the input column
    return joined.select(*map(named, rest), label.alias("value_label"), number.alias(value)).select(*map(named, rest), named(value), "value_label")


def normalise(
    df: DataFrame, method: str = "minmax", n: int = 10, code: str = "code", value: str = "numeric_value", single_column: bool = False, how: str = "auto", statistics: str | None = None
) -> DataFrame:
    """Fit and apply on the same table. ``statistics`` names a folder for the fitted table: if it exists it is used as it
    is, else it is written, so that later tables are normalised alike. Statistics of another method or other cut points
    are an error."""
    if statistics is None:
        return apply(df, fit(df, method, n, code, value, how), method, n, code, value, single_column)
    stats = saved_statistics(df.sparkSession, statistics, method, n)
    if stats is None:
        save_statistics(fit(df, method, n, code, value, how), statistics, method, n)
        stats = saved_statistics(df.sparkSession, statistics, method, n)
    return apply(df, stats, method, n, code, value, single_column)


def save_statistics(stats: DataFrame, path: str, method: str, n: int = 10) -> None:
    """A fitted table as a Parquet folder whose schema says by which method and at which points it was fitted."""
    of = {"method": method, "points": cut_points(method, n)}
    stats.withMetadata("cuts", of).write.parquet(path)


def saved_statistics(spark: SparkSession, path: str, method: str, n: int = 10) -> DataFrame | None:
    """The table that ``save_statistics`` wrote; None if there is none, an error if it was fitted otherwise."""
    try:
        stats = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    found = stats.schema["cuts"].metadata if "cuts" in stats.columns else {}
    if (found.get("method"), found.get("points")) != (method, cut_points(method, n)):
        raise SpecError(f"statistics in {path} are those of {found.get('method') or 'an unknown method'} at {found.get('points')}, not of {method} at {cut_points(method, n)}")
    return stats


def whole_subject_ids(df: DataFrame, column: str = "subject_id") -> DataFrame:
    """subject_id as a whole number; anything else is an error."""
    return df.withColumn(column, named(column).cast("bigint"))
