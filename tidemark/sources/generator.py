"""Deterministic synthetic staged rows, a function of seed, version and sequence number alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "v1"
# Fixed values of generated rows.
PUBLISHER, KIND, AUTHORS = "Open Metadata Benchmark", "journal-article", '[{"given":"Ada","family":"Benchmark"}]'
EPOCH, YEAR_SECONDS = 1_600_000_000, 31_536_000


def synthetic_rows(spark: SparkSession, rows: int, seed: int, execution_id: str = "benchmark", version: str = VERSION, start: int = 1) -> DataFrame:
    """Staged rows start to rows; the digests are of joined values, not of canonical JSON."""
    if version != VERSION:
        raise ValueError(f"unsupported generator version: {version}")
    if start < 1:
        raise ValueError("sequence numbers begin at 1")
    n = F.col("id").cast("string")
    at = F.timestamp_seconds(F.lit(EPOCH + seed % YEAR_SECONDS) + F.col("id"))
    base = spark.range(start, rows + 1).select("id", F.concat(F.lit(f"10.5555/benchmark-{version}-{seed}-"), n).alias("doi"), F.concat(F.lit("Synthetic work "), n).alias("title"), at.alias("indexed_at"), F.date_format(at, "yyyy-MM-dd").alias("issued_date"))
    second = F.expr("interval 1 second")
    return base.select(
        F.col("id").alias("staging_key"), F.lit(execution_id).alias("execution_id"), F.col("id").alias("execution_sequence"),
        F.concat(F.lit('{"DOI":"'), "doi", F.lit(f'","generatorVersion":"{version}"}}')).alias("source_json"),
        "doi", "title", F.lit(PUBLISHER).alias("publisher"), F.lit(KIND).alias("work_type"), "issued_date", F.lit(3).alias("issued_date_precision"),
        F.concat(F.lit("https://doi.org/"), "doi").alias("url"), F.lit(AUTHORS).alias("authors_json"), F.lit(1).alias("canonical_version"),
        F.sha2(F.concat_ws("|", "doi", "title", F.lit(PUBLISHER), "issued_date", F.lit(AUTHORS)), 256).alias("content_hash"), F.sha2(F.lit(AUTHORS), 256).alias("author_hash"),
        "indexed_at", (F.col("indexed_at") - second).alias("source_created_at"), (F.col("indexed_at") + second).alias("collected_at"), F.lit(None).cast("bigint").alias("source_error_key"),
    )
