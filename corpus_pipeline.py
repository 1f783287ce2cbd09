"""The corpus pipeline: from raw documents to packed token sequences.

Each stage takes the documents that the one before it kept. Rows with a null id
stay in all stages but the last, whose pieces then carry a null id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import gam, minhash, packing, passages, quality_rules
from tickerloom.llm.common import arrow_ready, table
from tickerloom.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, trained on ``labels``, scores 0.5 or more."""
    labels = table(spark, sf_dir, "labels")
    return gam.kept_documents(docs.select(COLUMNS), labels)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the quality rules, without their boilerplate lines."""
    arrow_ready(spark)
    kept = quality_rules.kept_documents(docs.select(COLUMNS))
    return with_length(kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of near duplicates."""
    arrow_ready(spark)
    docs = docs.select(COLUMNS)
    gone = (minhash.near_duplicates(docs, k=5, threshold=0.8).where(~F.col("kept"))
            .select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has as well; empty documents go."""
    arrow_ready(spark)
    docs = docs.select(COLUMNS)
    found = passages.repeated_passages(docs).checkpoint()
    return passages.without_passages(docs, found, length="n_chars").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all texts into sequences; one row per piece."""
    arrow_ready(spark)
    return packing.pack(docs, keep=["doc_id"])


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with the lengths of their texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packed),
]

# Trained scores, hashed signatures and token ids have no SQL form; the tests
# compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
