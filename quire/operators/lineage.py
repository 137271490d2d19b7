"""Version chains: predecessors, lineages, latest version, version as of a date."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import forget, stored, stored_by


def resolve_version(batch: DataFrame, state: DataFrame) -> DataFrame:
    """DUPLICATE, else CORRECTION, else NEW_VERSION, else NEW_DOCUMENT for every incoming row."""
    known = state.select("source", "source_document_id", F.col("id").alias("existing_id"))
    parents = state.select(
        "source", F.col("source_document_id").alias("supersedes"), F.col("id").alias("parent_id")
    )
    duplicate = F.col("existing_id").isNotNull()
    resolution = (
        F.when(duplicate, "DUPLICATE")
        .when(F.col("is_correction"), "CORRECTION")
        .when(F.col("parent_id").isNotNull(), "NEW_VERSION")
        .otherwise("NEW_DOCUMENT")
    )
    return (
        _with_parents(batch.join(known, ["source", "source_document_id"], "left"), parents, "parent_id")
        .withColumn("resolution", resolution)
        .withColumn("parent_id", F.when(~duplicate, F.col("parent_id")))
    )


def _with_parents(df: DataFrame, parents: DataFrame, name: str) -> DataFrame:
    """``df`` with the parent of its (source, supersedes). Rows that name none skip the join: as one key
    they would be most of the data in one task."""
    names_one = F.col("supersedes").isNotNull()
    joined = df.where(names_one).join(parents, ["source", "supersedes"], "left")
    without = df.where(~names_one).withColumn(name, F.lit(None).cast(parents.schema[name].dataType))
    return joined.unionByName(without)


def link_predecessors(batch: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Parent id of every batch row: the superseded row of the batch, else of the state.

    A row whose predecessor is unknown, and a correction that names none, needs review and is not
    latest.
    """
    keys = batch.select("source", "source_document_id", "id", F.lit(0).alias("rank"))
    if state is not None:
        keys = keys.unionByName(
            state.select("source", "source_document_id", "id", F.lit(1).alias("rank"))
        )
    parents = keys.groupBy("source", F.col("source_document_id").alias("supersedes")).agg(
        F.min_by("id", F.struct("rank", "id")).alias("parent_publication_id")
    )
    linked = _with_parents(batch.drop("parent_publication_id"), parents, "parent_publication_id")
    unresolved = F.col("parent_publication_id").isNull() & (
        F.col("supersedes").isNotNull() | F.col("is_correction")
    )
    return linked.withColumn("needs_review", unresolved)


def lineage_closure(edges: DataFrame) -> DataFrame:
    """Root and depth of every node of a parent forest, from (id, parent_publication_id).

    A parent that has no row is a root. Nodes on a cycle, or that hang on one, have a null root.
    """
    edges = stored(edges.select("id", "parent_publication_id"), "lineage-edges")
    parent = F.col("parent_publication_id")
    above = edges.select(F.col("id").alias("known"), parent.alias("above"))
    start = edges.where(parent.isNotNull()).join(above, parent == F.col("known"), "left").select(
        "id", parent.alias("ancestor"), F.lit(1).cast("bigint").alias("depth"), F.col("above").isNull().alias("done"))
    roots = edges.where(parent.isNull()).select("id", F.col("id").alias("root_id"), F.lit(0).cast("bigint").alias("depth"))
    return roots.unionByName(_closed(start))


def _closed(start: DataFrame) -> DataFrame:
    """(id, root_id, depth) of rows (id, ancestor, depth, done) by pointer jumping.

    The ancestor of a row that is done is its root; that of an open one is a row of ``start``. Each round
    doubles the distance a pointer covers, so a chain of depth n takes log2(n) rounds. A round moves the open
    rows only. Their distinct ancestors are looked up among the rows found in each earlier round, which lie
    in buckets of their ids and are not shuffled again; an ancestor of very many rows is one row there, and the
    join that hands its step out can be split. The nodes above one that takes long are reached in earlier
    rounds, so a round that reaches none proves that the rest goes round a cycle, or hangs on one: null root.
    """
    spark = start.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables, paths = [], []

    def laid(rows: DataFrame) -> tuple[int, int]:
        table, path = stored_by(rows.select("id", "ancestor", "depth", "done"), "lineage-round", ["id"], parts)
        tables.append(table)
        paths.append(path)
        counts = spark.table(table).groupBy("done").count().collect()
        return sum(r["count"] for r in counts if r["done"]), sum(r["count"] for r in counts if not r["done"])

    _, left = laid(start)
    while left:
        active = spark.table(tables[-1]).where("NOT done")
        wanted = active.select(F.col("ancestor").alias("id")).distinct().repartition(parts, "id")
        # An ancestor is either found in some round, and gives its root, or is open and moves on itself.
        steps = [wanted.join(rows, "id") for rows in (*(spark.table(t).where("done") for t in tables), active)]
        ahead = reduce(DataFrame.unionByName, steps).select(
            F.col("id").alias("via"), F.col("ancestor").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        found, left = laid(active.join(ahead, F.col("ancestor") == F.col("via")).select(
            "id", F.col("next").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done")))
        if not found:
            break
    forget(spark, tables)
    schema = start.select("id", "ancestor", "depth", "done").schema
    rounds = [spark.read.schema(schema).parquet(path) for path in paths]
    kind = start.schema["id"].dataType
    cyclic = rounds[-1].where("NOT done").select(
        "id", F.lit(None).cast(kind).alias("root_id"), F.lit(None).cast("bigint").alias("depth"))
    done = [rows.where("done").select("id", F.col("ancestor").alias("root_id"), "depth") for rows in rounds]
    return reduce(DataFrame.unionByName, [*done, cyclic])


def extend_closure(labels: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Union of an old label forest with a batch of edges: labels of the batch's ids, and the roots that moved.

    ``labels`` is (id, root_id, depth) as `lineage_closure` gives it; ``edges`` (id, parent_publication_id) has the
    new ids, and old roots that have got a parent. Parents are looked up in the labels, so a batch edge leads
    to a root, or to another row of the batch; only these edges are closed. The labels below a root that
    moved are not touched: ``moved`` (id, root_id, depth) tells where it went and how deep it lies there, and
    `moved_labels` brings it in. The cost is the batch's, with one join of its parents to the labels. A batch that
    closes a cycle, or hangs on one, has null roots, and so has what hangs on it.
    """
    edges = stored(edges.select("id", "parent_publication_id"), "batch-edges")
    parent = F.col("parent_publication_id")
    named = edges.where(parent.isNotNull())
    wanted = named.select(parent.alias("id")).distinct()
    known = labels.join(wanted, "id", "left_semi").select(
        F.col("id").alias("label_of"), F.col("root_id").alias("label_root"), F.col("depth").alias("label_depth"))
    # Where a parent's chain leads before the batch: to itself if it is new or unknown, else to its root.
    led = named.join(known, parent == F.col("label_of"), "left").select(
        "id", F.when(F.col("label_of").isNull(), parent).otherwise(F.col("label_root")).alias("ancestor"),
        (F.coalesce("label_depth", F.lit(0)) + 1).cast("bigint").alias("depth"))
    hanging = led.where("ancestor IS NULL").select("id", "ancestor", F.lit(None).cast("bigint").alias("depth"), F.lit(True).alias("done"))
    onward = named.select(F.col("id").alias("onward"))
    start = led.where("ancestor IS NOT NULL").join(onward, F.col("ancestor") == F.col("onward"), "left").select(
        "id", "ancestor", "depth", F.col("onward").isNull().alias("done"))
    roots = edges.where(parent.isNull()).select("id", F.col("id").alias("root_id"), F.lit(0).cast("bigint").alias("depth"))
    closed = stored(roots.unionByName(_closed(start.unionByName(hanging))), "batch-labels")
    return closed, closed.join(named.select("id"), "id", "left_semi")


def moved_labels(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """Labels with the moves of their roots: one hop, whatever the depth, as moves lead to final roots."""
    to = moved.select(F.col("id").alias("root_id"), F.col("root_id").alias("to_root"), F.col("depth").alias("more"),
                      F.lit(True).alias("went"))
    went = F.col("went").isNotNull()
    return labels.join(to, "root_id", "left").select(
        "id", F.when(went, F.col("to_root")).otherwise(F.col("root_id")).alias("root_id"),
        F.when(went, F.col("depth") + F.col("more")).otherwise(F.col("depth")).alias("depth"))


def _parents(publications: DataFrame) -> DataFrame:
    """Ids that some row names as its parent, each once: a parent of very many rows is one row here."""
    return publications.where("parent_publication_id IS NOT NULL").select(
        F.col("parent_publication_id").alias("id")
    ).distinct()


def terminal_versions(publications: DataFrame) -> DataFrame:
    """Publications nothing supersedes."""
    return publications.join(_parents(publications), "id", "left_anti")


def newest_first(published: Column, identity: Column) -> Column:
    """Ordering value whose maximum is the newest row: a missing time first, then time, then id."""
    return F.struct(published.isNull(), published, identity.cast("string"))


def latest_leaf_flag(publications: DataFrame, closure: DataFrame) -> DataFrame:
    """``is_latest_version`` for every publication: the newest terminal row of each lineage.

    A lone publication that needs review is not latest. Within a longer lineage the status is not
    looked at. Rows without a root, on a cycle or hanging on one, are of no lineage and never latest.
    """
    parents = _parents(publications).withColumn("is_parent", F.lit(True))
    rooted = publications.join(closure.select("id", "root_id"), "id")
    # One pass per lineage with map-side combine, over the columns it needs only.
    newest = newest_first(F.col("published_at"), F.col("id"))
    winners = rooted.where("root_id IS NOT NULL").select("root_id", "id", "published_at").join(parents, "id", "left").groupBy("root_id").agg(
        F.max_by("id", F.when(F.col("is_parent").isNull(), newest)).alias("id"),
        F.count(F.lit(1)).alias("size"),
    ).where("id IS NOT NULL").select("id", "size")
    latest = F.col("size").isNotNull() & ((F.col("size") > 1) | ~F.col("needs_review"))
    return (
        rooted.join(winners, "id", "left")
        .withColumn("is_latest_version", latest)
        .drop("size")
    )


def as_of_versions(publications: DataFrame, as_of: Sequence[str] | DataFrame) -> DataFrame:
    """The version of each lineage valid at each given date: (root_id, as_of, id).

    Rows published later are invisible. A row without a publication time counts from its date-only
    update. A list of dates is a parameter: one conditional aggregate each, one pass. A table
    (root_id, as_of) asks for each of its lineages at its own times; see `_as_of_table`.
    """
    known = F.coalesce(F.col("published_at"), F.col("source_updated_date").cast("timestamp_ntz"))
    order = F.struct(known, F.col("id").cast("string"), F.col("id").alias("id"))
    if isinstance(as_of, DataFrame):
        return _as_of_table(publications.where(known.isNotNull() & F.col("root_id").isNotNull()), known, as_of)
    picks = [
        F.max(F.when(known <= F.lit(day).cast("timestamp_ntz"), order)).alias(f"at_{i}")
        for i, day in enumerate(as_of)
    ]
    chosen = publications.groupBy("root_id").agg(*picks)
    rows = F.array(*[
        F.struct(F.lit(day).alias("as_of"), F.col(f"at_{i}.id").alias("id"))
        for i, day in enumerate(as_of)
    ])
    return chosen.select("root_id", F.inline(rows)).where("id IS NOT NULL")


def _as_of_table(publications: DataFrame, known: Column, asked: DataFrame) -> DataFrame:
    """Newest version at or before the time of each request, without a product of versions and requests.

    Versions and requests lie in one order of lineage and time, dealt by ranges of it, so one lineage of very
    many rows is cut by time. In each range a request takes the last version before it; one that comes
    before the first version of its range takes what the earlier ranges of its lineage ended with, of
    which there is a row per lineage and range.
    """
    newest = publications.groupBy("root_id", known.alias("at")).agg(
        F.max(F.struct(F.col("id").cast("string").alias("text"), F.col("id").alias("id"))).alias("newest"))
    versions = newest.select("root_id", "at", F.col("newest.id").alias("id"), F.lit(None).cast(asked.schema["as_of"].dataType).alias("as_of"))
    requests = asked.where("root_id IS NOT NULL").select("root_id", "as_of").distinct().select(
        "root_id", F.col("as_of").cast("timestamp_ntz").alias("at"), F.lit(None).cast(publications.schema["id"].dataType).alias("id"), "as_of")
    order = ["root_id", "at", F.col("id").isNull()]
    dealt = stored(versions.unionByName(requests.where("at IS NOT NULL")).repartitionByRange(*order).withColumn(
        "part", F.spark_partition_id()), "as-of-ranges")
    within = Window.partitionBy("root_id", "part").orderBy("at", F.col("id").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = dealt.withColumn("seen", F.last("id", ignorenulls=True).over(within)).where("as_of IS NOT NULL")
    ends = dealt.groupBy("root_id", "part").agg(F.max_by("id", F.when(F.col("id").isNotNull(), F.col("at"))).alias("end"))
    earlier = Window.partitionBy("root_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("root_id", "part", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    found = seen.join(carried, ["root_id", "part"]).select("root_id", "as_of", F.coalesce("seen", "carried").alias("id"))
    return found.where("id IS NOT NULL")


def prefer_source_tier(
    df: DataFrame, subject: Sequence[str], tiers: dict[str, str], better: str = "A", worse: str = "C"
) -> DataFrame:
    """Drop rows of the worse tier where the better one covers the same subject."""
    tier = F.lit(None).cast("string")
    for source, name in tiers.items():
        tier = F.when(F.col("source") == source, name).otherwise(tier)
    ranked = df.withColumn("tier", tier)
    covered = ranked.where(F.col("tier") == better).select(*subject).distinct()
    covered = covered.withColumn("tier", F.lit(worse))
    return ranked.join(covered, [*subject, "tier"], "left_anti")
