"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import running_start, table, tied, written
from quire.llm.mixing import source_key
from quire.llm.registry import query

SHARDS = 8
SEED = 29
SPAN = float(1 << 52)


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, source_rank) per row of ``docs``.

    Rows are shuffled by a seeded number within each source and ranked; a row's fractional rank is (rank + 1/2)
    over its source's rows. In order of fractional rank the rows are cut into ``shards`` runs whose lengths
    differ by one at most (law ``rows``), so each shard has every source in proportion. ``slot`` is the place
    in the shard. A null text has size 1 and the checksum of no bytes; rows without a source are a source
    of their own. Equal texts are rows of their own and may fall into different shards: a group of copies
    may be larger than a shard. Ranks are counted by buckets, so no source is sorted in one task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), source_key(F.col("source")).alias("key"))
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"))
    rows = written(rows.withColumn("unit", tied(identity, seed)), "shard-rows")
    total = rows.count()
    buckets = max(1, round(4 * total ** 0.5))
    # As a whole number, unit * buckets would pass 64 bits from 2048 buckets on; as a double it keeps the order.
    share = F.col("unit").cast("double") / SPAN
    rows = rows.withColumn("bucket", F.floor(share * buckets)).withColumn("one", F.lit(1))
    ranked = running_start(rows, ["key"], "bucket", ["unit", "doc_id", "text_crc32", "size"], "one", "source_rank")
    counts = rows.groupBy("key").agg(F.count("*").alias("source_rows"))
    ranked = ranked.join(counts, "key").withColumn("place", (F.col("source_rank") + 0.5) / F.col("source_rows"))
    ranked = ranked.withColumn("bucket", F.floor(F.col("place") * buckets))
    ordered = running_start(ranked, [], "bucket", ["place", "key", "source_rank"], "one", "position")
    ordered = ordered.withColumn("shard", F.expr(f"(position * {shards}) div {max(1, total)}"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "source_rank")


@query("op9_interleaved_shards")
def op9_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    return interleave(table(spark, folder, "documents"))
