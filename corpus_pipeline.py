"""Training-corpus pipeline: STAGES in order, each one operator of ledgerlake.llm.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents`` (the last one: the mix). run()
writes each stage as Parquet in the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, mixing, ngram_join, pii, quality_classifier
from ledgerlake.llm.scratch import packed, stored, unpacked


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality_classifier.classify(packed(docs, "doc_id", "text"), labels).filter("predicted = 1")
    return unpacked(kept, docs.columns, "doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of every group of near copies."""
    return ngram_join.drop_near_duplicates(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the text where it changed."""
    kept = ("text", "n_chars")
    found = pii.find_personal_data(packed(docs, *kept)).withColumn("changed", F.size("spans") > 0)
    out = pii.mask(found)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("changed"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return unpacked(out, docs.columns, *kept)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each slot and part of a document in it."""
    return mixing.mix(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark), ("PII", personal_data),
          ("mixing sources to target weights", mix)]
ORACLE_SQL = None  # the classifier and the seeded mix have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
