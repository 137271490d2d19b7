"""N-gram Jaccard join: a MinHash LSH forest finds candidates, shared word shingles verify them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.blocks import by_pair, in_blocks, spanning, square
from quire.llm.common import WORD, components, row_key, table, written
from quire.llm.registry import query

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, SHORTEST = 16, 7, 2
TARGET_RECALL = 0.995
#: Pairs whose signatures agree less are no candidates: 4.5 standard errors below the threshold.
ESTIMATE_FLOOR = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / (TREES * DEPTH)) ** 0.5
SIGNATURE_BLOCK, TEXT_BLOCK = 512, 256
_random = np.random.default_rng(5)
FACTORS = _random.integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 62, TREES * DEPTH, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
_word = re.compile(WORD)
_odd_space = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # what str.split() takes for white space too


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words; fewer words are one run, none give none."""
    words = _word.findall(text or "") if _odd_space.search(text or "") else (text or "").split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    runs = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        runs = runs * BASE + hashes[k:len(hashes) - width + 1 + k]
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def signature(runs: np.ndarray) -> np.ndarray:
    """MinHash values, 32 bits each."""
    least = np.full(TREES * DEPTH, 1 << 32, np.uint64)
    for at in range(0, len(runs), 2048):
        hashed = (runs[at:at + 2048, None] * FACTORS + OFFSETS) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0), out=least)
    return least.astype(np.uint32)


def sketch(text: Column) -> Column:
    """struct(set, signature): digest and MinHash of the text's shingles; null where it has no word."""

    @F.arrow_udf("struct<set:binary,signature:binary>")
    def sketch_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets, signatures = [], []
            for text in batch:
                runs = shingles(text.as_py())
                sets.append(hashlib.blake2b(runs.tobytes(), digest_size=16).digest() if len(runs) else None)
                signatures.append(signature(runs).tobytes() if len(runs) else None)
            yield pa.StructArray.from_arrays([pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())],
                                             ["set", "signature"])

    return sketch_texts(text)


def found_at(similarity: np.ndarray, depth: int) -> np.ndarray:
    """The chance that two sets share a prefix of ``depth`` values in a tree of the forest at least."""
    return 1 - (1 - similarity ** depth) ** TREES


def _agreement(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The share of equal MinHash values of each signature with each other one."""
    return np.stack([(others == row).mean(axis=1) for row in own])


def _cross_edges(linked: np.ndarray, own: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """One linked pair for each two groups of the blocks that links within the blocks make anyway."""
    group = [np.arange(len(m)) for m in (own, others)]
    for labels, inside in zip(group, (own, others)):
        for member, root in spanning(inside):
            labels[member] = root
    rows, columns = np.nonzero(linked)
    pairs = np.unique(np.stack([group[0][rows], group[1][columns]], axis=1), axis=0, return_index=True)[1]
    return [(int(rows[k]), int(columns[k])) for k in pairs]


def _links_seen(signatures: np.ndarray, estimates: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each set of a block the links seen with the others of it, and how many are to be expected by that.

    A link is seen in every tree where both share the prefix, and counts its part each time; of links of its
    similarity only a share is seen at this depth, which tells how many there are.
    """
    found, expected = np.zeros(len(signatures)), np.zeros(len(signatures))
    for i, row in enumerate(signatures):
        near = np.flatnonzero(estimates[i] >= THRESHOLD)
        near = near[near != i]
        if len(near):
            equal = (signatures[near] == row).reshape(-1, TREES, DEPTH)
            parts = 1 / np.maximum(equal[:, :, :depth].all(axis=2).sum(axis=1), 1)
            found[i], expected[i] = parts.sum(), (parts / found_at(estimates[i][near], depth)).sum()
    return found, expected


def _compare_signatures(depth: int):
    """Rows (a, b) of candidates, and (a, null, found, expected) of the links of sets that share a block."""

    def compare(left: list[tuple], right: list[tuple]) -> Iterator[tuple]:
        left, right = sorted(left), sorted(right)  # so that the same members make the same edges in every tree
        own = np.frombuffer(b"".join(r[1] for r in left), "<u4").reshape(-1, TREES * DEPTH)
        others = np.frombuffer(b"".join(r[1] for r in right), "<u4").reshape(-1, TREES * DEPTH) if right else own
        estimates = _agreement(own, others)
        linked = estimates >= ESTIMATE_FLOOR
        if right:
            # Each block also meets itself elsewhere, so here only what connects the two is told.
            within = [_agreement(m, m) >= ESTIMATE_FLOOR for m in (own, others)] if linked.any() else []
            edges = [(left[i][0], right[j][0]) for i, j in _cross_edges(linked, *within)] if within else []
        else:
            edges = [(left[i][0], left[j][0]) for i, j in spanning(linked)]
            found, expected = _links_seen(own, estimates, depth)
            for i in np.flatnonzero(found):
                yield left[i][0], None, float(found[i]), float(expected[i])
        yield from ((a, b, 0.0, 0.0) for a, b in edges)

    return compare


def _satisfied(rows: DataFrame, depth: int) -> DataFrame:
    """(set): sets whose expected recall at this depth reaches ``TARGET_RECALL``.

    Besides the links seen each set is taken to have one more at the threshold, which the prefix may have missed:
    a set without links, or with a few, is looked up again by a shorter prefix.
    """
    missed = float(found_at(THRESHOLD, depth))
    recall = (F.sum("found") + missed) / (F.sum("expected") + 1)
    return rows.where("b is null").groupBy(F.col("a").alias("set")).agg(recall.alias("recall")).where(
        F.col("recall") >= TARGET_RECALL).select("set")


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, component): sets (set, signature) that a chain of candidate pairs connects.

    Each tree of the forest sorts the sets by its own MinHash values; sets that share a prefix are candidates
    and are compared by signature. All sets are looked up by the longest prefixes first. Prefixes are shortened for
    the sets that are not ``_satisfied``, until all are; the others can still be found by them. Buckets without a
    set that is looked up are left out, so a group of many near copies is met once, at the longest prefix.
    """
    edges, satisfied = [], sets.select("set").limit(0)
    for depth in range(DEPTH, SHORTEST - 1, -1):
        prefix = lambda t: F.xxhash64(F.lit(t), F.substring("signature", 4 * DEPTH * t + 1, 4 * depth))  # noqa: B023, E731
        asked = sets.join(satisfied.withColumn("done", F.lit(True)), "set", "left").select(
            "set", "signature", F.col("done").isNull().alias("asked"))
        codes = asked.select("set", "asked", F.explode(F.array(*(prefix(t) for t in range(TREES)))).alias("code"))
        buckets = codes.groupBy("code").agg(F.count("*").alias("n"), F.max("asked").alias("any")).where("n > 1 and any")
        shared = codes.join(buckets, "code").select("code", "set")
        dealt = in_blocks(shared, "code", "set", SIGNATURE_BLOCK).join(sets.select("set", "signature"), "set")
        rows = written(by_pair(
            dealt.select("pair", "side", "set", "signature"), _compare_signatures(depth),
            "a binary, b binary, found double, expected double", ["a", "b", "found", "expected"],
            [pa.binary(), pa.binary(), pa.float64(), pa.float64()]), "forest-edges")
        edges.append(rows.where("b is not null").select("a", "b"))
        if found_at(THRESHOLD, depth) >= TARGET_RECALL:
            break  # here the missed link is found often enough too, so every set is satisfied
        satisfied = written(satisfied.union(_satisfied(rows, depth)).distinct(), "forest-satisfied")
    return components(reduce(DataFrame.union, edges), "forest")


def shared_counts(own: list[np.ndarray], others: list[np.ndarray] | None) -> np.ndarray:
    """Numbers of common values of each two different sets, by products of blocks of their incidence matrix."""
    sets = own + (others or [])
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, places, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[places] > 1
    order = np.argsort(places[common], kind="stable")
    rows, places = rows[common][order], places[common][order]
    width, counts = 4096, np.zeros((len(own), len(others) if others else len(own)), np.float32)
    new = np.cumsum(np.concatenate([[0], (np.diff(places) > 0)])) if len(places) else places
    for start in range(0, int(new[-1]) + 1 if len(new) else 0, width):
        low, high = np.searchsorted(new, [start, start + width])
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[rows[low:high], new[low:high] - start] = 1
        counts += matrix[:len(own)] @ (matrix[len(own):] if others else matrix).T
    return counts


def _verify(left: list[tuple], right: list[tuple]) -> Iterator[tuple]:
    """Exact links of two blocks: per set the rows it is linked with here, and edges that connect the linked."""
    names, weights = [r[0] for r in left + right], np.array([r[1] for r in left + right])
    own, others = [shingles(r[2]) for r in left], [shingles(r[2]) for r in right]
    sizes, n = np.array([len(s) for s in own + others]), len(own)
    common = shared_counts(own, others or None)
    either = sizes[:n, None] + (sizes[n:] if others else sizes) - common
    linked = common >= THRESHOLD * either - 1e-6
    if others:
        links = np.concatenate([linked @ weights[n:], weights[:n] @ linked])
        linked = square(linked)
    else:
        np.fill_diagonal(linked, False)
        links = linked @ weights
    roots = dict(spanning(linked))
    for i in np.flatnonzero(links):
        yield names[i], names[roots.get(int(i), int(i))], int(links[i])


def similarity_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): ``rows`` has (doc_id, key, set) of each row of ``docs``; ``sets`` has for each distinct set of
    shingles (set, rows, n_links, class_id, first_key, is_first).

    ``n_links`` are the other rows whose shingles have Jaccard similarity of at least ``THRESHOLD``;
    ``class_id`` is the smallest doc_id that links reach, and ``first_key`` the row that stands for the class.
    Equal sets are compared once. Rows without a word have a null set and no links.
    """
    rows = written(docs.select("doc_id", row_key(docs).alias("key"), sketch(F.col("text")).alias("s")).select(
        "doc_id", "key", "s.set", "s.signature"), "shingle-rows")
    sets = written(rows.where("set is not null").groupBy("set").agg(
        F.count("*").alias("rows"), F.min("doc_id").alias("first_id"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))).alias("first"),
        F.min("signature").alias("signature")), "shingle-sets")
    groups = written(candidate_groups(sets).join(sets, F.col("node") == F.col("set")).select(
        "set", "component", "rows", F.col("first.key").alias("key")), "shingle-groups")
    texts = (docs.select(row_key(docs).alias("key"), F.col("text")).join(groups, "key")
             .groupBy("set").agg(F.first("component").alias("component"), F.first("rows").alias("rows"),
                                 F.first("text").alias("text")))
    verified = written(by_pair(
        in_blocks(texts, "component", "set", TEXT_BLOCK).select("pair", "side", "set", "rows", "text"), _verify,
        "set binary, root binary, links long", ["set", "root", "links"], [pa.binary(), pa.binary(), pa.int64()]),
        "shingle-links")
    links = verified.groupBy("set").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("set").alias("a"), F.col("root").alias("b")), "shingle-classes")
    known = sets.drop("signature").join(links, "set", "left").join(
        classes.select(F.col("node").alias("set"), F.col("component").alias("class")), "set", "left")
    known = written(known.select("set", "rows", "first_id", "first", F.coalesce("class", "set").alias("class"), (
        F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "shingle-known")
    firsts = known.groupBy("class").agg(F.min("first_id").alias("class_id"), F.min("first").alias("class_first"))
    return rows, known.join(firsts, "class").select("set", "rows", "n_links", "class_id",
                                                    F.col("class_first.key").alias("first_key"))


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) per row of ``docs`` (doc_id, text); see ``similarity_classes``.

    Rows without a word stand alone, with their own doc_id as class. A class of rows without ids has no id.
    """
    rows, sets = similarity_classes(docs)
    found = rows.select("doc_id", "set").join(sets, "set", "left")
    return found.select(
        "doc_id", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_first_of_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id; rows without a word all stay."""
    rows, sets = similarity_classes(docs)
    first = sets.select(F.col("first_key").alias("key")).distinct()
    wordless = F.coalesce("text", F.lit("")).rlike(WORD)
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), row_key(docs).alias("key"), wordless.alias("has_words"))
    kept = keyed.where("has_words").join(first, "key").groupBy("key").agg(F.first("doc").alias("doc"))
    return kept.select("doc.*").unionByName(keyed.where("not has_words").select("doc.*"))


@query("op2_shingle_join")
def op2_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))
