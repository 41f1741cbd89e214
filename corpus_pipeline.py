"""Corpus pipeline: documents to clean, deduplicated, decontaminated, redacted and encoded training text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontaminate, personal_data, quality, set_join
from eventloom.llm.jobs import written

#: Up to so many dropped ids (8 bytes each) are sent to every task; more of them are joined by a shuffle.
MAX_SENT_IDS = 500_000


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``dropped``; rows with a null doc_id stay."""
    ids = written(dropped.select("doc_id").distinct())
    few = ids.limit(MAX_SENT_IDS + 1).count() <= MAX_SENT_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside its held-out fold. Null and empty
    texts are scored as empty ones; repeated rows and null ids are judged each by their text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels, quality.learning_rows()))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at least 0.8 similarity of five-word shingles connect: the smallest id.

    Rows of one doc_id are one document, of which one row stays. Texts without a word are in no group but that of their
    doc_id; rows with a null doc_id stay.
    """
    found = written(set_join.jaccard_components(docs, set_join.Rule(k=5, num=80, den=100)).select("doc_id", "component_id").filter("doc_id is not null"))
    kept = without(docs, found.filter("component_id <> doc_id"))
    several = written(found.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if several.isEmpty():
        return kept
    rows = kept.join(several, "doc_id", "left_semi").select(*docs.columns)
    one = rows.groupBy(F.col("doc_id").alias("__id")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    return without(kept, several).unionByName(one.select("__row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts, null ids and repeated rows stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text. Null texts stay null."""
    out = personal_data.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the hashes of ids and decoded text; a null text has no ids."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [("quality", classify), ("jaccard", deduplicate), ("decontamination", decontaminated), ("personal_data", redact), ("bpe", encode)]
#: Learned models and token ids are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
