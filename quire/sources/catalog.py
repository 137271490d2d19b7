"""Disclosure catalogs: JSON arrays of publications with nested attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.files import RANGE_BYTES, json_elements, list_files

ATTACHMENT = "struct<filename:string,download_reference:string,reported_mime_type:string>"
CATALOG_SCHEMA = (
    "ticker string, source_document_id string, title string, published_at string, "
    "document_type string, is_correction boolean, supersedes_source_document_id string, "
    f"detail_reference string, metadata map<string,string>, attachments array<{ATTACHMENT}>"
)


def with_defaults(raw: DataFrame, source: str = "FIXTURE") -> DataFrame:
    """Catalog rows with the defaults of the feed; the text time keeps its own offset."""
    return raw.select(
        F.lit(source).alias("source"), F.upper("ticker").alias("ticker"), "source_document_id",
        "title", "published_at",
        F.to_timestamp("published_at").alias("published_instant"),
        F.coalesce("document_type", F.lit("other")).alias("document_type"),
        F.coalesce("is_correction", F.lit(False)).alias("is_correction"),
        F.col("supersedes_source_document_id").alias("supersedes"),
        F.col("detail_reference").alias("source_reference"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
        F.coalesce("attachments", F.array().cast(f"array<{ATTACHMENT}>")).alias("attachments"),
    )


def read_disclosure_catalog(
    spark: SparkSession, path: str, source: str = "FIXTURE", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Catalog files under a path; one JSON array per file, or objects one after the other.

    Files are listed and cut into ranges by tasks, so one large file is read by many (`json_elements`).
    """
    elements = json_elements(list_files(spark, path), range_bytes)
    return with_defaults(elements.select(F.from_json("element", CATALOG_SCHEMA).alias("p")).select("p.*"), source)


def parse_disclosure_catalog(texts: DataFrame, source: str = "FIXTURE") -> DataFrame:
    """The same from a column ``json`` that holds one JSON array per row."""
    items = F.from_json("json", f"array<struct<{CATALOG_SCHEMA}>>")
    return with_defaults(texts.select(F.inline(items)), source)


def attachments(publications: DataFrame) -> DataFrame:
    """One row per attachment."""
    return publications.select(
        "source", "source_document_id", F.inline("attachments")
    ).withColumnRenamed("download_reference", "attachment_reference")
