"""Upserts into bucketed state: a batch reads the buckets of its keys and writes the rows that it changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import lineage as L
from quire.operators import upserts as U
from quire.plans.keyed_state import BUCKETS, KeyedState
from quire.session import stored


def upsert_publications_into(state: KeyedState, batch: DataFrame, now: Column, version: int) -> bool:
    """`upsert_publications` of a batch. The state's schema has ``created``, of a row's last batch."""
    if state.committed(version):
        return False
    known = state.lookup(batch, before=version).drop("created")
    return state.write(U.upsert_publications(known, batch, now), version)


def insert_into(state: KeyedState, batch: DataFrame, order: Sequence[str | Column], version: int) -> bool:
    """Insert the batch rows whose key the state lacks, the first of a repeated key (`ensure_raw_objects`, `ensure_artifacts`)."""
    if state.committed(version):
        return False
    fresh = U.first_per_key(batch.select(*state.schema.names), state.keys, order)
    # The shuffle that finds the first of a key deals it into its bucket, where the state's rows lie.
    with state.dealing():
        return state.write(fresh.join(state.lookup(batch, before=version), state.keys, "left_anti"), version, dealt=True)


def replace_in(state: KeyedState, batch: DataFrame, version: int, processed: DataFrame | None = None) -> bool:
    """`replace_document_output`: the rows of each processed key go, the batch's come. A rerun adds nothing."""
    return state.write(batch, version, keys=processed)


class PublicationState:
    """Publications with parents, roots and latest flags, kept up by batches that touch their own lineages only.

    Three tables of keyed state: publications by natural key; the members of each lineage by its root; and the
    rows that wait for a predecessor by the key they name. A batch looks up its own keys, the rows they
    supersede, the rows that wait for them, and the lineages of all these. Its edges extend the closure of
    those lineages (`extend_closure`), flags are worked out anew within them, and the rows that changed are
    written. So a batch costs its own lineages, not the state. The three writes of a version end with the
    publications; a batch that failed between them runs again on what older versions hold.
    """

    def __init__(self, spark: SparkSession, root: str, schema, buckets: int = BUCKETS):
        kind = {f.name: f.dataType.simpleString() for f in schema}
        extra = f"needs_review boolean, root_id {kind['id']}, depth long, created boolean"
        names = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in ("needs_review", "root_id", "depth", "created")]
        key = f"source {kind['source']}, source_document_id {kind['source_document_id']}"
        make = lambda name, columns, keys: KeyedState(spark, f"{root}/{name}", columns, keys, buckets)
        self.publications = make("publications", ", ".join([*names, extra]), U.PUBLICATION_KEY)
        self.members = make("members", f"root string, id {kind['id']}, {key}", ["root"])
        self.waiting = make("waiting", f"source {kind['source']}, supersedes string, source_document_id {kind['source_document_id']}",
                            ["source", "supersedes"])

    def read(self, before: int | None = None) -> DataFrame:
        return self.publications.read(before)

    def apply(self, batch: DataFrame, now: Column, version: int) -> bool:
        """Upsert and link one batch (with ``seq``, its order of arrival); False if the version is there already."""
        if self.publications.committed(version):
            return False
        pubs, key = self.publications, list(U.PUBLICATION_KEY)
        batch = stored(batch, "state-batch")
        derived = ["needs_review", "root_id", "depth", "created"]
        known = stored(pubs.lookup(batch, version), "state-known")
        merged = stored(U.upsert_publications(known.drop(*derived), batch, now), "state-merged")
        created = merged.where("created")
        # Rows that the new ones supersede, and rows that waited for a new one.
        named = created.where("supersedes IS NOT NULL").select("source", F.col("supersedes").alias("source_document_id"))
        older = pubs.lookup(named, version)
        waited = pubs.lookup(self.waiting.lookup(
            created.select("source", F.col("source_document_id").alias("supersedes")), version), version)
        beside = stored(older.unionByName(waited).unionByName(known).dropDuplicates(key), "state-beside")
        # All members of their lineages; those of the batch as the batch leaves them.
        root = F.coalesce(F.col("root_id").cast("string"), F.lit("~"))
        roots = stored(beside.select(root.alias("root")).distinct(), "state-roots")
        members = stored(pubs.lookup(self.members.lookup(roots, version), version), "state-members")
        old = members.join(merged.select(*key), key, "left_anti").drop(*derived)
        rows = stored(old.unionByName(merged.drop("created")), "state-rows")
        linked = stored(L.link_predecessors(rows), "state-linked")
        # Parents are fixed once found, so a batch's edges start at its new rows, and at rows that had none.
        settled = members.where("parent_publication_id IS NOT NULL").select("id")
        edges = linked.select("id", "parent_publication_id").join(settled, "id", "left_anti")
        edges = edges.where("parent_publication_id IS NOT NULL").unionByName(
            edges.where("parent_publication_id IS NULL").join(members.select("id"), "id", "left_anti"))
        labels = members.select("id", "root_id", "depth")
        found, moved = L.extend_closure(labels, edges)
        fresh = found.join(labels.select("id"), "id", "left_anti")
        closure = stored(L.moved_labels(labels, moved).unionByName(fresh), "state-closure")
        flagged = L.latest_leaf_flag(linked, closure.select("id", "root_id")).join(closure.select("id", "depth"), "id")
        flagged = flagged.join(merged.select("id", "created"), "id", "left").withColumn("created", F.coalesce("created", F.lit(False)))
        flagged = stored(flagged.select(*pubs.schema.names), "state-flagged")
        before = members.withColumn("created", F.lit(False)).select(*pubs.schema.names)
        changed = flagged.join(before, [flagged[c].eqNullSafe(before[c]) for c in pubs.schema.names], "left_anti")
        changed = changed.unionByName(flagged.join(merged.select("id"), "id", "left_semi")).dropDuplicates(key)
        # Rosters of the roots touched; waiting rows by the keys of this batch's lineages.
        rosters = flagged.select(root.alias("root"), "id", *key)
        self.members.write(rosters, version, keys=roots.unionByName(rosters.select("root")))
        unlinked = flagged.where("supersedes IS NOT NULL AND parent_publication_id IS NULL").select("source", "supersedes", "source_document_id")
        wanted = flagged.where("supersedes IS NOT NULL").select("source", "supersedes").distinct()
        others = self.waiting.lookup(wanted, version).join(flagged.select(*key), key, "left_anti")
        self.waiting.write(unlinked.unionByName(others.select(*unlinked.columns)), version, keys=wanted)
        return pubs.write(changed, version)

    def compact(self, least: int = 8, keep: int = 1) -> None:
        for table in (self.members, self.waiting, self.publications):
            table.compact(least, keep)
