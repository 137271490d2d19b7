"""Comparing the members of groups without a pair of rows for each pair of members."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(members: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """Deal the members of each group into blocks of about ``block``, and copy each to the pairs of its block.

    Adds ``pair``, which names group and two blocks, and ``side``: 0 or 1 for the two blocks of a pair, 2 where
    a block meets itself. Each two members meet in just one pair. A group of n members makes (n / block)^2 / 2
    pairs, of bounded size, on as many tasks; a member is copied n / block times.
    """
    counts = members.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = members.join(counts, group).withColumn("_parts", F.ceil(F.col("_n") / block))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(F.lit("block"), member), F.col("_parts")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") == low, 0).otherwise(1)
    pair = F.concat_ws(":", F.col(group).cast("string") if members.schema[group].dataType.typeName() != "binary"
                       else F.hex(group), low.cast("string"), high.cast("string"))
    return dealt.withColumn("pair", pair).withColumn("side", side.cast("int")).drop("_n", "_parts", "_own", "_other", group)


def by_pair(
    dealt: DataFrame, compare: Callable[[list[tuple], list[tuple]], Iterator[tuple]], schema: str, names: list[str],
    kinds: list[pa.DataType],
) -> DataFrame:
    """Rows that ``compare(left, right)`` yields for each pair of blocks of ``in_blocks``.

    A block that meets itself comes as ``(rows, [])``. Pairs are dealt out by hash and arrive sorted, so a task
    holds the rows of one pair at a time.
    """
    columns = [c for c in dealt.columns if c not in ("pair", "side")]
    ordered = dealt.select("pair", "side", *columns).repartition("pair").sortWithinPartitions("pair", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, out = None, ([], [], []), []

        def settle() -> None:
            if now is not None:
                out.extend(compare(sides[2], []) if sides[2] else compare(sides[0], sides[1]))

        def flush() -> pa.RecordBatch:
            values = list(zip(*out)) or [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)
            out.clear()
            return batch

        for batch in batches:
            for pair, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if pair != now:
                    settle()
                    now, sides = pair, ([], [], [])
                    if len(out) > 20_000:
                        yield flush()
                sides[side].append(tuple(row))
        settle()
        yield flush()

    return ordered.mapInArrow(run, schema)


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, root) that connect what the symmetric boolean matrix connects, one per member but roots."""
    n = len(linked)
    left, edges = np.ones(n, bool), []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            reached = np.flatnonzero(linked[front].any(axis=0) & left)
            left[reached] = False
            edges += [(int(i), root) for i in reached]
            front = reached
    return edges


def square(cross: np.ndarray) -> np.ndarray:
    """The symmetric matrix over both sides of a comparison of two different blocks."""
    a, b = cross.shape
    whole = np.zeros((a + b, a + b), bool)
    whole[:a, a:] = cross
    whole[a:, :a] = cross.T
    return whole
