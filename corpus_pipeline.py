"""From raw documents to packed token ids, in five stages.

Each stage is written as Parquet and read again as the documents of the next one. All but the last
return the columns of ``documents``; the last returns the ids, the digests and the text's size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import bpe, decontaminate, paragraphs, probminhash, site_quality
from docflow.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier rejects go."""
    return site_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return probminhash.keep_one(docs)


def repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs and passages that an earlier place holds go; ``n_chars`` follows the text."""
    kept = paragraphs.remove_repeated(docs)
    changed = (F.size("removed_places") > 0) | (F.size("removed_short") > 0) | (F.size("removed_passages") > 0)
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover five percent or more go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, packed, with the digests of the ids and of the decoded text."""
    made = bpe.encode_documents(docs)
    return made.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_paragraphs", repeated_paragraphs),
    ("benchmark_passages", benchmark_passages),
    ("encode", encode),
]

# A trained classifier, signatures and merges are not SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
