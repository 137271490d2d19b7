"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import new_shared_path

#: The white space that separates words, as a regular expression class.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: later steps survive lost executors."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_key(docs: DataFrame) -> Column:
    """Names a row by id and text; rows that agree in both are interchangeable."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")),
                       F.hex(F.xxhash64(F.coalesce("text", F.lit("")))))


#: Rows that go to Python at once where whole texts do; Spark's own limit counts 10,000 rows, however long.
ROWS_AT_ONCE = 1_024


def in_small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python a thousand rows at a time: JVM and worker each hold a batch, and copies of it.

    A smaller number that the session has stays. Documents whose languages are fitted together change with it, so their
    shares can move within the fit's `CLOSE`.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ROWS_AT_ONCE:
        spark.conf.set(key, str(ROWS_AT_ONCE))


class Memo(dict):
    """A cache of at most ``limit`` entries that starts anew when it is full. It only saves time."""

    def __init__(self, compute: Callable, limit: int = 300_000, longest: int = 80):
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def running_start(
    df: DataFrame, group: Iterable[str], bucket: str, order: Iterable[Column | str], weight: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all earlier rows of the group, by (bucket, order).

    Buckets are summed first and only their totals are summed over the whole group; rows meet only the
    rows of their own bucket, so a hot group is spread over its buckets. Group columns hold no nulls.
    """
    group, order = list(group), list(order)
    df = df.repartition(*group, bucket)  # else rows that come dealt by group alone would stay together
    totals = df.groupBy(*group, bucket).agg(F.sum(weight).alias("_total"))
    over_group = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, bucket, F.coalesce(F.sum("_total").over(over_group), F.lit(0)).alias("_ahead"))
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(totals, [*group, bucket])
        .withColumn(name, F.col("_ahead") + F.coalesce(F.sum(weight).over(inner), F.lit(0)))
        .drop("_ahead")
    )


def components(edges: DataFrame, name: str = "components", rounds: int | None = None) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component), the smallest node id reachable.

    Each round every node takes the smallest label among its neighbours' labels, then its label's own
    label (pointer jumping). Labels are written to the shared folder each round; the loop ends when a
    round changes nothing. Sums per node are combined before they are shuffled, and the label side of
    each join has one row per node, so a node with very many edges can be split.
    """
    edges = edges.where("a <> b")
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("near"))
                     .select(F.col("a").alias("node"), F.least("a", "near").alias("component")), name)
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near")))
        stepped = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        labels_next = written(
            stepped.join(jump, stepped.component == jump.via, "left")
            .select("node", "before", F.least("component", F.coalesce("further", "component")).alias("component")),
            name)
        changed = labels_next.where("before <> component").limit(1).count()
        labels = labels_next.select("node", "component")
        if not changed:
            return labels


def tied(key: Column, seed: int) -> Column:
    """A seeded, uniform 52-bit number of ``key`` that any SQL engine with md5 can repeat."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("long")
