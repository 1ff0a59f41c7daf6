"""From raw documents to packed sequences: quality, exact and near duplicates, benchmark passages, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from placewright.llm import decontam, exact_dedup, jaccard, packing, quality
from placewright.llm._io import shared_dir
from placewright.llm.queries import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's and length's threshold."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their five-word shingles, the one with the smallest doc_id."""
    return jaccard.drop_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in benchmark passages of 13 words."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [("quality classifier", good_quality), ("exact dedup", one_of_equals), ("n-gram Jaccard join", one_of_near), ("benchmark decontamination", clean_of_benchmark), ("mixture packing", packed)]

#: The model, the links and the tokenizer are beyond SQL; tests hold run() against a brute-force run of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/stage-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
