"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir), works on every row that the stage before kept, and returns the columns of
documents; the last returns pieces of sequences. Nulls, empty texts and repeated rows are handled as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dedup, packing, quality, secrets
from tidemark.llm.text import fresh, load, released, shared_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to this stage's own input, doesn't reject.

    Where the labels are too few to fit one to, or of one kind, none is rejected.
    """
    v, model = quality.fitted(docs, load(spark, sf_dir, "labels"))
    if isinstance(model, quality.Constant):
        return docs
    score = fresh("quality_score", docs.columns)
    return quality.with_score(docs, v, model, score).where(F.col(score) >= quality.THRESHOLD).select(docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return near_dedup.deduplicated(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminated(docs, load(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by their kind, and n_chars of the text as it is now."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES = [("quality", good), ("near duplicates", distinct), ("decontamination", clean), ("secrets", redacted), ("packing", packed)]

#: None of the classifier, the components and the packing can be stated in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = released(spark.read.parquet(f"{folder}/{k}"))
    return docs
