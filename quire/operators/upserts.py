"""State tables: insert, refresh and replace by natural key.

State is a parquet table. Every function returns the next snapshot; `quire.plans.snapshots` writes
it beside the old one and moves the pointer last, so a failed or repeated run changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import values as V

PUBLICATION_KEY = ("source", "source_document_id")
# Columns a repeated publication refreshes; every other one keeps its first value.
REFRESHED = (
    "title", "document_type", "published_at", "source_updated_date", "published_at_precision",
    "scope", "audit_status", "language", "source_reference",
)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``: an aggregate with map-side combine, not a window."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def upsert_publications(state: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Insert publications by (source, source_document_id), or refresh the listed columns only.

    The batch carries ``seq``, its arrival order: of several rows with one key the first decides the
    columns an insert fixes and the last decides the refreshed ones, as if they came one by one.
    The result has the state's columns and ``created``.
    """
    fixed = [c for c in state.columns if c not in (*PUBLICATION_KEY, *REFRESHED, "updated_at")]
    incoming = batch.groupBy(*PUBLICATION_KEY).agg(
        F.min_by(F.struct(*[c for c in fixed if c in batch.columns]), "seq").alias("born"),
        F.max_by(F.struct(*REFRESHED), "seq").alias("fresh"),
    )
    stored = state.withColumn("stored", F.lit(True))
    joined = stored.join(incoming, list(PUBLICATION_KEY), "full_outer")
    known, seen = F.col("stored").isNotNull(), F.col("fresh").isNotNull()
    columns = {
        **{c: F.when(seen, F.col(f"fresh.{c}")).otherwise(F.col(c)) for c in REFRESHED},
        **{c: F.when(known, F.col(c)).otherwise(F.col(f"born.{c}"))
           for c in fixed if c in batch.columns},
        "updated_at": F.when(seen, now).otherwise(F.col("updated_at")),
    }
    return joined.select(
        *[columns.get(c, F.col(c)).alias(c) for c in state.columns], (~known).alias("created")
    )


def publication_flags(batch: DataFrame) -> DataFrame:
    """Parent, latest flag and status a new publication starts with.

    A successor starts as not latest: only linking it to its predecessor makes it so. A correction
    that names no predecessor needs review.
    """
    orphan = F.col("is_correction") & F.col("supersedes").isNull()
    return batch.withColumns({
        "parent_publication_id": F.lit(None).cast(batch.schema["id"].dataType),
        "is_latest_version": F.col("supersedes").isNull() & ~orphan,
        "processing_status": F.when(orphan, "NEEDS_REVIEW").otherwise("PENDING"),
    })


def insert_if_absent(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """State plus the batch rows whose key it lacks; the first row of a repeated key is kept."""
    fresh = first_per_key(batch.select(*state.columns), keys, order)
    return state.unionByName(fresh.join(state.select(*keys), list(keys), "left_anti"))


def ensure_raw_objects(state: DataFrame, batch: DataFrame, order=("created_at", "id")) -> DataFrame:
    return insert_if_absent(state, batch, ["sha256"], order)


def ensure_artifacts(state: DataFrame, batch: DataFrame, order=("created_at", "id")) -> DataFrame:
    return insert_if_absent(state, batch, ["publication_id", "attachment_reference"], order)


def purge_by_document(state: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """State without the rows of the given documents."""
    return state.join(documents.select(key).distinct(), key, "left_anti")


def replace_document_output(
    state: DataFrame, batch: DataFrame, key: str = "document_id", processed: DataFrame | None = None
) -> DataFrame:
    """Drop all rows of every processed document, then add its new rows: reruns never duplicate.

    ``processed`` names documents whose new output may be empty.
    """
    documents = batch.select(key) if processed is None else processed.select(key)
    return purge_by_document(state, documents, key).unionByName(batch)


def seed_dimension(state: DataFrame, rows: DataFrame, key: str = "ticker") -> DataFrame:
    """Dimension rows with the missing ones added and flagged ``created``."""
    fresh = first_per_key(rows.select(*state.columns), [key], [c for c in state.columns if c != key])
    fresh = fresh.join(state.select(key), key, "left_anti")
    return state.withColumn("created", F.lit(False)).unionByName(
        fresh.withColumn("created", F.lit(True))
    )


def mark_publications(
    state: DataFrame,
    ids: DataFrame,
    latest: bool | None = None,
    status: str | None = None,
) -> DataFrame:
    """Set the latest flag and/or the status of the publications listed by id."""
    if status is not None and status not in V.PROCESSING_STATUSES:
        raise ValueError(f"unknown status {status!r}")
    marked = state.join(
        ids.select("id").distinct().withColumn("marked", F.lit(True)), "id", "left"
    )
    hit = F.col("marked").isNotNull()
    if latest is not None:
        marked = marked.withColumn(
            "is_latest_version", F.when(hit, F.lit(latest)).otherwise(F.col("is_latest_version"))
        )
    if status is not None:
        marked = marked.withColumn(
            "processing_status", F.when(hit, F.lit(status)).otherwise(F.col("processing_status"))
        )
    return marked.select(*state.columns)
