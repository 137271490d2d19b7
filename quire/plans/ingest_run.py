"""One ingest run over every company at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators import ingest as I
from quire.operators import lineage as L
from quire.operators import upserts as U
from quire.session import stored


def publish(state: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Upsert a batch and recompute parents and latest flags of the whole state.

    The result depends on the set of rows only, not on their order of arrival: ``needs_review`` is
    worked out anew and kept beside the stored status, so a late predecessor clears it.
    """
    merged = U.upsert_publications(state, batch, now)
    linked = stored(L.link_predecessors(merged), "linked-publications")
    return L.latest_leaf_flag(linked, L.lineage_closure(linked))


def shown_status() -> Column:
    return F.when(F.col("needs_review"), "NEEDS_REVIEW").otherwise(F.col("processing_status"))


def store_attachments(
    attachments: DataFrame, raw_state: DataFrame, artifact_state: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New raw objects and artifacts for the attachments not stored yet."""
    pending = I.pending_attachments(attachments, artifact_state)
    return U.ensure_raw_objects(raw_state, pending), U.ensure_artifacts(artifact_state, pending)


def latest_with_artifacts(
    state: DataFrame, batch: DataFrame, attachments: DataFrame, now: Column
) -> DataFrame:
    """Latest version of every publication with its artifacts, each reference once."""
    latest = publish(state, batch, now).where("is_latest_version").select(
        F.col("id").alias("publication_id"), "company_id", "source", "source_document_id", "root_id",
        "published_at",
    )
    artifacts = U.first_per_key(
        attachments.select("publication_id", "attachment_reference", "created_at", "id"),
        ["publication_id", "attachment_reference"], ["created_at", "id"],
    ).select("publication_id", "attachment_reference", F.col("id").alias("artifact_id"))
    return latest.join(artifacts, "publication_id")
