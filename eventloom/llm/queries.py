"""The registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import alignment, bpe, decontaminate, html_text, langid, licences, nearest, periods, personal_data, piece_bpe, quality, set_join, suffixes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.jaccard_components(table(spark, sf_dir, "documents"), set_join.Rule(k=4, num=85, den=100))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf_dir, "documents"), periods.repeated_tail)


NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_suffix_dedup, op2_jaccard_join, op3_decontamination, op4_language_id, op5_personal_data, op6_html_text, op7_nearest, op8_bpe, op9_quality, op10_licences,
        op11_alignment, op12_piece_bpe, op13_periodic_runs,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op7_nearest": NEAREST_SQL}
