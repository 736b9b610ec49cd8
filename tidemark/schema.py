"""Schemas, allowed values and the contract of the canonical form."""

from __future__ import annotations

import hashlib

from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "timestamp": TimestampType()}


def struct(columns: str = "", **nested: DataType) -> StructType:
    """`name type, ...` of plain types, then nested ones; needs no session."""
    plain = [StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(", ") if c)]
    return StructType([*plain, *(StructField(n, t) for n, t in nested.items())])


_STAMP = struct("date-time string")
ITEM = struct(
    "DOI string, publisher string, type string, URL string",
    title=ArrayType(StringType()), issued=struct(**{"date-parts": ArrayType(ArrayType(IntegerType()))}), author=ArrayType(struct("given string, family string, ORCID string")), indexed=_STAMP, created=_STAMP,
)
PAGE = struct("status string, message-type string, message-version string", message=struct("next-cursor string, total-results bigint, items-per-page int", items=ArrayType(ITEM)))

CANONICAL = "doi string, title string, publisher string, work_type string, issued_date string, issued_date_precision int, url string, authors_json string, canonical_version int, content_hash string, author_hash string"
STAGING = struct(f"staging_key bigint, execution_id string, execution_sequence bigint, source_json string, {CANONICAL}, indexed_at timestamp, source_created_at timestamp, collected_at timestamp, source_error_key bigint")
TARGET = struct(f"id string, {CANONICAL}, source_indexed_at timestamp, created_at timestamp, updated_at timestamp")
ERRORS = struct("error_key bigint, execution_id string, staging_key bigint, error_type string, error_code string, message string, status string, replay_count int, created_at timestamp, resolved_at timestamp")
CHUNKS = struct(
    "execution_id string, chunk_sequence bigint, first_staging_key bigint, last_staging_key bigint, inserted_count bigint, superseded_count bigint, no_op_count bigint, conflict_count bigint, index_advanced_count bigint, updated_count bigint, validation_error_count bigint"
)
# The longest value that a column may hold, the outcomes of a row, and the code of a conflict.
LIMITS = {"doi": 255, "publisher": 512, "work_type": 100, "url": 2048}
CANONICAL_COLUMNS = [part.split()[0] for part in CANONICAL.split(", ")]

OUTCOMES = ("INSERTED", "SUPERSEDED", "NO_OP", "CONFLICT", "INDEX_ADVANCED", "UPDATED")
COUNTERS = tuple(f"{x.lower()}_count" for x in (*OUTCOMES, "VALIDATION_ERROR"))
MODES = ("BACKFILL", "INCREMENTAL", "REPLAY_ERRORS", "BENCHMARK")
CONFLICT_CODE = "SAME_TIMESTAMP_DIFFERENT_CONTENT"
CHUNK_SIZE, PAGE_SIZE, PAGE_CAP = 1000, 1000, 100_000

#: Fixed value: the description whose digest identifies the canonical form.
CONTRACT = "canonicalVersion=1|unicode=NFC|whitespace=collapse|doi=trim-lower|type=trim-lower|issued=year-month-day-precision|authors=source-order|content=doi,title,publisher,type,issued,url,authors"
CONTRACT_HASH = hashlib.sha256(CONTRACT.encode()).hexdigest()
