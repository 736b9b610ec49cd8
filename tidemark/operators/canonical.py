"""Source records to their canonical form, with digests of content and of authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import date_parts, instant, nfc, partial_date, plain

_JSON = {"ignoreNullFields": "false"}


def canonicalize(items: DataFrame, item: str = "item") -> DataFrame:
    """Adds the canonical columns of a struct column of source records to the other columns of items.

    The whole record is composed once, as JSON, so a row passes Python at most once. doi, indexed_at or both are null
    where a record lacks them; see rejected.
    """
    composed = items.withColumn("_c", F.from_json(nfc(F.to_json(item)), schema.ITEM))
    parts = date_parts(F.col("_c.issued.date-parts"))
    titles = F.filter(F.transform("_c.title", plain), lambda t: t.isNotNull())
    people = F.coalesce(F.filter("_c.author", lambda a: a.isNotNull()), F.array().cast("array<struct<given:string,family:string,ORCID:string>>"))
    authors = F.transform(people, lambda a: F.struct(plain(a["given"]).alias("given"), plain(a["family"]).alias("family"), plain(a["ORCID"]).alias("orcid")))
    work = F.struct(
        F.lit(1).alias("canonicalVersion"),
        F.lower(plain(F.col("_c.DOI"))).alias("doi"),
        F.get(titles, F.lit(0)).alias("title"),
        plain(F.col("_c.publisher")).alias("publisher"),
        F.lower(plain(F.col("_c.type"))).alias("type"),
        partial_date(parts).alias("issuedDate"),
        F.when(parts.isNotNull(), F.size(parts)).alias("issuedDatePrecision"),
        plain(F.col("_c.URL")).alias("url"),
        authors.alias("authors"),
    )
    w = F.col("_w")
    return (
        composed.withColumn("_w", work)
        .select(
            *items.columns,
            F.to_json(item).alias("source_json"),
            w["doi"].alias("doi"), w["title"].alias("title"), w["publisher"].alias("publisher"), w["type"].alias("work_type"),
            w["issuedDate"].alias("issued_date"), w["issuedDatePrecision"].alias("issued_date_precision"), w["url"].alias("url"),
            F.to_json(w["authors"], _JSON).alias("authors_json"),
            F.lit(1).alias("canonical_version"),
            F.to_json(w, _JSON).alias("canonical_json"),
            instant(F.col("_c.indexed.date-time")).alias("indexed_at"),
            instant(F.col("_c.created.date-time")).alias("source_created_at"),
        )
        .withColumn("content_hash", F.sha2("canonical_json", 256))
        .withColumn("author_hash", F.sha2("authors_json", 256))
    )


def rejected(works: DataFrame) -> DataFrame:
    """The canonical rows that must not be staged, with the reason: no DOI, no indexed time, a value too long."""
    reason = F.when(F.col("doi").isNull(), "DOI is required").when(F.col("indexed_at").isNull(), "indexed time is required")
    for column, most in schema.LIMITS.items():
        reason = reason.when(F.length(column) > most, f"{column} is longer than {most}")
    return works.withColumn("reason", reason).where("reason is not null")
