"""Approximate nearest neighbours with an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.blocks import by_pair
from quire.llm.common import table, written
from quire.llm.registry import query
from quire.llm.vectors import kmeans, squared, usable

NEAREST, QUERY_EVERY = 10, 100
TRAINING_SAMPLE, AUDITED, TARGET_RECALL = 20_000, 64, 0.97
MOST_CENTRES = 1_024
ENTRIES_PER_BLOCK, QUERIES_PER_BLOCK = 4_096, 1_024


class Books(NamedTuple):
    """Centres of the two halves of all vectors; a cell is a pair of them."""

    first: np.ndarray
    second: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return squared(vectors[:, :cut], self.first), squared(vectors[:, cut:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.halves(vectors)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def traversal(self, vector: np.ndarray) -> Iterator[int]:
        """Cells by the sum of the distances of both halves, nearest first: the multi-sequence walk."""
        a, b = (d[0] for d in self.halves(vector[None]))
        along, down = a.argsort(kind="stable"), b.argsort(kind="stable")
        a, b = a[along].tolist(), b[down].tolist()
        along, down = along.tolist(), down.tolist()
        heap, done = [(a[0] + b[0], 0, 0)], [0] * len(a)  # how many cells of each row are out
        while heap:
            _, i, j = heapq.heappop(heap)
            yield along[i] * len(b) + down[j]
            done[i] = j + 1
            if i + 1 < len(a) and done[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(values), -1) if len(values) else np.empty((0, 0))


def cell_of(vector: Column, books: Books) -> Column:
    @F.arrow_udf("int")
    def find_cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(books.cells(_matrix(batch)).astype("i4") if len(batch) else [], pa.int32())

    return find_cells(vector)


def nearest_here(vectors: np.ndarray, ids: list[list[int]], query: np.ndarray, query_id: int, nearest: int) -> list:
    """(score, vec_id) of the nearest entries, exact in double precision, without the query's own id."""
    rough = squared(query[None], vectors)[0]
    if len(rough) > nearest + 1:
        bound = np.partition(rough, nearest)[nearest]
        keep = np.flatnonzero(rough <= bound + 1e-9 * max(1.0, bound))
    else:
        keep = np.arange(len(rough))
    scores = np.sqrt(((vectors[keep] - query) ** 2).sum(axis=1)).tolist()
    return sorted((s, i) for s, k in zip(scores, keep) for i in ids[k] if i != query_id)[:nearest]


def distinct_vectors(vectors: DataFrame, nearest: int) -> DataFrame:
    """(embedding, ids): each different vector with its smallest ids, one more than are asked for.

    Of equal vectors no query can be given more than these, so the others need not be compared.
    """
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return (vectors.withColumn("_rank", first).where(F.col("_rank") <= nearest + 1)
            .groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))


def _audit(entries: DataFrame, sample: list, nearest: int, books: Books, counts: np.ndarray) -> int:
    """Entries to be visited so that the audited queries, brute force taken as truth, reach the target recall."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, ids, cells = _matrix(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            rows = []
            for query_id, query in sample if len(ids) else []:
                where = {i: int(c) for found, c in zip(ids, cells) for i in found}
                rows += [(query_id, s, where[i]) for s, i in nearest_here(vectors, ids, query, query_id, nearest)]
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                columns, (pa.int64(), pa.float64(), pa.int32()))], ["query_id", "score", "cell"])

    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score"))
    truth = entries.select("embedding", "ids", "cell").mapInArrow(scan, "query_id long, score double, cell int")
    truth = truth.withColumn("rank", order).where(F.col("rank") <= nearest).select("query_id", "cell").collect()
    wanted: dict[int, list[int]] = {}
    for row in truth:
        wanted.setdefault(row["query_id"], []).append(row["cell"])
    needed = []
    for query_id, query in sample:
        left, seen = wanted.get(query_id, []), 0
        for cell in books.traversal(query):
            seen += int(counts[cell])
            needed += [seen] * left.count(cell)
            left = [c for c in left if c != cell]
            if not left:
                break
    return int(np.quantile(needed, TARGET_RECALL, method="higher")) if needed else 1


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, centres: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``nearest`` vectors found for each of ``queries`` (vec_id, embedding).

    Vectors are cut in halves, each half quantised by its own centres; a cell is a pair of centres. Centres
    are fitted on ``TRAINING_SAMPLE`` vectors at most, the index holds every vector. A query walks the cells by
    summed distance until it has seen as many entries as the audit asks for: the number by which ``AUDITED``
    queries, compared with all vectors, reach ``TARGET_RECALL``. Entries are reranked by Euclidean distance in
    double precision, ties to the smaller id. There are about 4 * n^(1/4) centres a half, ``MOST_CENTRES`` at
    most, so what is broadcast is bounded: centres, and one number per cell.

    Rows whose vector is null, zero, or holds null or non-finite components, and rows without id, take no part. Vectors
    of each length have an index of their own, as there is no distance between lengths. A query isn't given its
    own id; a walk goes on until it has seen more vectors than are asked for. Large cells are spread over blocks
    of entries, and blocks that many queries visit are copied for parts of the queries.
    """
    usual = lambda df: df.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    distinct = written(distinct_vectors(usual(vectors), nearest), "index-vectors")
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = {r["width"]: r["count"] for r in distinct.groupBy(F.size("embedding").alias("width")).count().collect()}
    for width in sorted(sizes):
        fits = F.size("embedding") == width
        found = found.unionByName(_search(distinct.where(fits), sizes[width], usual(queries).where(fits), width, nearest, centres))
    return found


def _search(distinct: DataFrame, n: int, queries: DataFrame, width: int, nearest: int, centres: int | None) -> DataFrame:
    """`nearest_neighbours` among ``n`` distinct vectors of one length."""
    sample = distinct.orderBy(F.xxhash64("embedding")).limit(TRAINING_SAMPLE).select("embedding").toArrow()
    points = _matrix(sample.column(0).combine_chunks())
    k = centres or min(MOST_CENTRES, max(2, round(4 * n ** 0.25)))
    cut = max(1, width // 2)
    books = Books(kmeans(points[:, :cut], k), kmeans(points[:, cut:], k) if width > 1 else np.zeros((1, 0)))
    entries = written(distinct.withColumn("cell", cell_of(F.col("embedding"), books)), "index-entries")

    counts = np.zeros(len(books.first) * len(books.second), np.int64)
    for row in entries.groupBy("cell").count().toLocalIterator():
        counts[row["cell"]] = row["count"]
    audited = [(r["vec_id"], np.array(r["embedding"], float)) for r in
               queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(AUDITED).collect()]
    visit = max(_audit(entries, audited, nearest, books, counts), nearest + 1)
    before = np.concatenate([[0], np.cumsum(counts)])
    first_block = before[:-1] // ENTRIES_PER_BLOCK  # cells in order fill blocks; a large cell goes over several
    blocks_of = np.maximum((before[1:] - 1) // ENTRIES_PER_BLOCK, first_block) - first_block + 1

    @F.arrow_udf("array<struct<block:int,cells:array<int>>>")
    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("block", pa.int32()), ("cells", pa.list_(pa.int32()))]))
        for batch in batches:
            rows = []
            for query in _matrix(batch):
                seen, wanted = 0, {}
                for cell in books.traversal(query):
                    if counts[cell]:
                        seen += counts[cell]
                        for block in range(first_block[cell], first_block[cell] + blocks_of[cell]):
                            wanted.setdefault(block, []).append(cell)
                    if seen >= visit:
                        break
                rows.append([{"block": b, "cells": c} for b, c in wanted.items()])
            yield pa.array(rows, kind)

    @F.arrow_udf("int")
    def place(cells: pa.Array, keys: pa.Array) -> pa.Array:
        cells = cells.to_numpy()
        return pa.array((first_block[cells] + keys.to_numpy() % blocks_of[cells]).astype("i4"), pa.int32())

    probes = written(queries.withColumn("probe", F.explode(walk("embedding"))).select(
        F.col("probe.block").alias("block"), F.col("vec_id").alias("query_id"), "embedding", "probe.cells"), "index-probes")
    parts = probes.groupBy("block").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("int").alias("parts"))
    pair = F.concat_ws(":", F.col("block").cast("string"), F.col("part").cast("string"))
    shape = ["embedding", "ids", "cells"]
    left = (entries.withColumn("block", place("cell", F.abs(F.xxhash64("embedding") % 1_000_003)))
            .join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(pair.alias("pair"), F.lit(0).alias("side"), "embedding", "ids", F.array("cell").alias("cells")))
    right = (probes.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")))
             .select(pair.alias("pair"), F.lit(1).alias("side"), "embedding", F.array("query_id").alias("ids"), "cells"))

    def rerank(index: list[tuple], asked: list[tuple]) -> Iterator[tuple]:
        if not index:
            return
        matrix, ids = np.array([r[0] for r in index], float), [r[1] for r in index]
        cells = np.array([r[2][0] for r in index])
        for embedding, (query_id,), wanted in asked:
            here = np.flatnonzero(np.isin(cells, wanted))
            for score, vec_id in nearest_here(matrix[here], [ids[i] for i in here], np.array(embedding, float),
                                              query_id, nearest):
                yield query_id, vec_id, score

    found = by_pair(left.unionByName(right).select("pair", "side", *shape), rerank,
                    "query_id long, vec_id long, score double", ["query_id", "vec_id", "score"],
                    [pa.int64(), pa.int64(), pa.float64()])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


@query("op5_multi_index")
def op5_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
