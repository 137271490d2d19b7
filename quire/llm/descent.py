"""Near-duplicate vectors by NN-descent on a neighbour graph."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.blocks import by_pair, in_blocks, spanning, square
from quire.llm.common import components, table, written
from quire.llm.registry import query
from quire.llm.vectors import usable

THRESHOLD = 0.98
NEIGHBOURS, MOST_NEIGHBOURS = 12, 48
PROPOSED = 4  # neighbours that a local join proposes to a member whose list isn't saturated
TABLES, BUCKET = 6, 64
AUDITED, TARGET_RECALL, MOST_ROUNDS, MOST_SEARCHES = 512, 0.99, 12, 4
PLANTED, NEAREST_PLANT = 512, 0.999  # perturbed copies added for the search to find, and their largest cosine
CENTRED = 64  # vectors of a label whose mean its hyperplanes go through
FEW_EDGES = 0.02
BLOCK = 512
HALF_ERROR = 0.003  # half precision moves a cosine by less
ANGLE_ERROR = 1e-6  # rounding of angles in double precision


def unit(label: Column, vector: Column) -> Column:
    """struct(key, unit): a digest of label and vector, and the vector at length 1 in double precision."""

    @F.arrow_udf("struct<key:binary,unit:binary>")
    def scale(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for labels, vectors in batches:
            keys, units = [], []
            for name, values in zip(labels, vectors):
                if not values.is_valid:
                    keys.append(None)
                    units.append(None)
                    continue
                row = values.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                largest = np.abs(row).max()
                scaled = row / largest
                keys.append(hashlib.blake2b(f"{name}\0".encode() + row.tobytes(), digest_size=16).digest())
                units.append((scaled / np.sqrt((scaled * scaled).sum())).tobytes())
            yield pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(units, pa.binary())], ["key", "unit"])

    return scale(label.cast("string"), F.when(usable(vector) & label.isNotNull(), vector))


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)


def _half(units: Column) -> Column:
    """Units in half precision, for searching only; links are verified in double precision."""

    @F.arrow_udf("binary")
    def shorten(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.frombuffer(u.as_buffer(), "<f8").astype("<f2").tobytes() for u in batch], pa.binary())

    return shorten(units)


def _codes(units: Column, centres: Column, bits: int, turn: int) -> Column:
    """The side of random hyperplanes through the centre that each vector lies on, ``bits`` of them for each of ``TABLES``."""

    @F.arrow_udf("array<long>")
    def sides(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for units, centres in batches:
            codes: list = []
            for u, c in zip(units, centres):
                row = np.frombuffer(u.as_buffer(), "<f2").astype("f4") - np.frombuffer(c.as_buffer(), "<f4")
                planes = _planes(len(row), bits, turn)
                codes.append((((planes @ row) > 0).reshape(TABLES, bits) @ (1 << np.arange(bits))).tolist())
            yield pa.array(codes, pa.list_(pa.int64()))

    return sides(units, centres)


_plane_cache: dict[tuple[int, int, int], np.ndarray] = {}


def _planes(width: int, bits: int, turn: int) -> np.ndarray:
    if (width, bits, turn) not in _plane_cache:
        if len(_plane_cache) >= 8:
            _plane_cache.clear()
        _plane_cache[width, bits, turn] = np.random.default_rng((7, turn)).standard_normal((TABLES * bits, width)).astype("f4")
    return _plane_cache[width, bits, turn]


def _centres(vertices: DataFrame) -> DataFrame:
    """(label, centre): the mean of ``CENTRED`` vectors of each label, so that planes part directions that crowd.

    Planes through the origin leave the vectors of a narrow cone on one side. The sample only places the planes.
    """

    @F.arrow_udf("binary")
    def mean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.mean([np.frombuffer(h, "<f2").astype("f4") for h in row.as_py()], axis=0).astype("<f4").tobytes()
                            for row in batch], pa.binary())

    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("node"), "node"))
    few = vertices.select("label", "node", "half").withColumn("rank", rank).where(F.col("rank") <= CENTRED)
    return few.groupBy("label").agg(F.sort_array(F.collect_list("half")).alias("halves")).select(
        "label", mean(F.col("halves")).alias("centre"))


def _join_members(rows: list[tuple], _: list[tuple]) -> Iterator[tuple]:
    """For each member (node, half, wanted, fresh) of a group the nearest others, fresh pairs only."""
    nodes = np.array([r[0] for r in rows])
    fresh = np.array([r[3] for r in rows])
    if len(rows) < 2 or not fresh.any():
        return
    matrix = np.frombuffer(b"".join(r[1] for r in rows), "<f2").reshape(len(rows), -1).astype("f4")
    near = matrix @ matrix.T
    near[~(fresh[:, None] | fresh)] = -2
    near[nodes[:, None] == nodes] = -2
    for i, row in enumerate(rows):
        wanted = min(row[2], len(rows) - 1)
        best = np.argpartition(-near[i], wanted - 1)[:wanted]
        for j in best[near[i, best] > -2]:
            yield row[0], int(nodes[j]), float(near[i, j])


def _local_joins(groups: DataFrame) -> DataFrame:
    """(node, near, score) proposed by comparing the members of each group (pair, node, half, wanted, fresh)."""
    return by_pair(groups.select("pair", F.lit(2).alias("side"), "node", "half", "wanted", "fresh"), _join_members,
                   "node long, near long, score float", ["node", "near", "score"], [pa.int64(), pa.int64(), pa.float32()])


def _best(proposed: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """The graph of the nearest proposed neighbours, each node with as many as it wants."""
    rank = F.dense_rank().over(Window.partitionBy("node").orderBy(F.desc("score"), "near"))
    ranked = proposed.withColumn("rank", rank).where(F.col("rank") <= MOST_NEIGHBOURS)
    if wanted is None:
        ranked = ranked.where(F.col("rank") <= NEIGHBOURS)
    else:
        ranked = ranked.join(wanted.select("node", "list"), "node", "left").where(
            F.col("rank") <= F.coalesce("list", F.lit(NEIGHBOURS)))
    return ranked.groupBy("node", "near").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))


def _bucketed(vertices: DataFrame, centres: DataFrame, n: int, turn: int) -> DataFrame:
    """(node, near, score, fresh) proposed among vectors of one label on the same side of random hyperplanes, in
    groups of bounded size. Each ``turn`` draws other planes."""
    bits = max(1, round(np.log2(max(2, n / BUCKET))) - 2)
    coded = vertices.join(centres, "label").select("node", "half", "label", F.posexplode(
        _codes(F.col("half"), F.col("centre"), bits, turn)).alias("table", "code"))
    bucket = ["label", "table", "code"]
    parts = coded.groupBy(*bucket).agg(F.ceil(F.count("*") / (4 * BUCKET)).alias("parts"))
    part = F.pmod(F.xxhash64("node", "table", F.lit(turn)), F.col("parts"))
    name = F.concat_ws(":", "label", "table", "code", part)
    groups = coded.join(parts, bucket).select(name.cast("string").alias("pair"), "node", "half",
                                              F.lit(NEIGHBOURS).alias("wanted"), F.lit(True).alias("fresh"))
    return _local_joins(groups).withColumn("fresh", F.lit(True))


def _descend(graph: DataFrame, vertices: DataFrame, wanted: DataFrame) -> DataFrame:
    """One round: the neighbours of each node, and the nodes it is a neighbour of, are compared with each other.

    Returns the graph and what the comparisons propose.
    """
    out = graph.select(F.col("node").alias("centre"), F.col("near").alias("node"), "score", "fresh")
    back = graph.select(F.col("near").alias("centre"), "node", "score", "fresh")
    rank = F.row_number().over(Window.partitionBy("centre").orderBy(F.desc("score"), "node"))
    around = out.union(back).withColumn("rank", rank).where(F.col("rank") <= 2 * MOST_NEIGHBOURS)
    around = around.join(wanted.select(F.col("node").alias("centre"), "list"), "centre", "left").where(
        F.col("rank") <= 2 * F.coalesce("list", F.lit(NEIGHBOURS)))
    groups = around.join(vertices.select("node", "half"), "node").join(
        wanted.select("node", F.col("list").alias("wanted")), "node", "left").select(
        F.col("centre").cast("string").alias("pair"), "node", "half",
        F.coalesce("wanted", F.lit(PROPOSED)).alias("wanted"), "fresh")
    return _local_joins(groups).withColumn("fresh", F.lit(True)).unionByName(graph.withColumn("fresh", F.lit(False)))


def _perturbed(units: Column) -> Column:
    """Each unit vector turned in a random direction, to a cosine between the threshold and ``NEAREST_PLANT``."""

    @F.arrow_udf("binary")
    def turn(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            turned = []
            for u in batch:
                row = np.frombuffer(u.as_buffer(), "<f8")
                rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(row.tobytes(), digest_size=8).digest(), "little"))
                noise = rng.standard_normal(len(row))
                noise -= (noise @ row) * row
                length = np.sqrt(noise @ noise)
                cosine = rng.uniform(THRESHOLD + 5e-4, NEAREST_PLANT)
                if length > 1e-9:  # at width 1 there is no other direction
                    row = cosine * row + np.sqrt(1 - cosine * cosine) * noise / length
                turned.append((row / np.sqrt(row @ row)).tobytes())
            yield pa.array(turned, pa.binary())

    return turn(units)


def planted(vertices: DataFrame) -> DataFrame:
    """Vertices (node, label, unit, half) that are perturbed copies of ``PLANTED`` sampled ones.

    The copy of node n is node -1 - n, so the link that a search should find is known, however rare links are.
    """
    sample = vertices.orderBy(F.xxhash64("unit", "node")).limit(PLANTED)
    copies = sample.select((-1 - F.col("node")).alias("node"), "label", _perturbed(F.col("unit")).alias("unit"))
    return copies.withColumn("half", _half(F.col("unit")))


def true_links(vertices: DataFrame, plants: DataFrame) -> DataFrame:
    """(node, near, kind): the links to audit a search by.

    ``planted`` ones lead from a plant to the vertex it copies. ``few`` and ``many`` are links of ``AUDITED`` sampled
    vertices, by brute force: of vertices with less than ``NEIGHBOURS`` links, and of the others. Each task tells at
    most ``NEIGHBOURS`` links of a vertex: this is enough for the audit, and large groups don't outweigh the others.
    """
    sample = vertices.orderBy(F.xxhash64("unit")).limit(AUDITED).select("node", "label", "unit").toArrow()
    by_label: dict[str, list] = {}
    for node, label, data in zip(*(c.to_pylist() for c in sample.columns)):
        by_label.setdefault(label, []).append((node, data))
    asked = {k: (np.array([i for i, _ in v]), b"".join(u for _, u in v)) for k, v in by_label.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = {label: np.zeros(len(names), int) for label, (names, _) in asked.items()}
        for batch in batches:
            rows: dict[str, list] = {}
            for node, label, data in zip(*(c.to_pylist() for c in batch.columns)):
                if label in asked:
                    rows.setdefault(label, []).append((node, data))
            for label, here in rows.items():
                names, data = asked[label]
                others = np.frombuffer(data, "<f8").reshape(len(names), -1)
                for at in range(0, len(here), BLOCK):
                    nodes = np.array([r[0] for r in here[at:at + BLOCK]])
                    linked = _matrix([r[1] for r in here[at:at + BLOCK]]) @ others.T >= THRESHOLD
                    linked &= nodes[:, None] != names
                    linked &= linked.cumsum(axis=0) + told[label] <= NEIGHBOURS
                    told[label] += linked.sum(axis=0)
                    i, j = np.nonzero(linked)
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(names[j]), pa.array(nodes[i])], ["node", "near"])

    links = vertices.select("node", "label", "unit").mapInArrow(scan, "node long, near long")
    counts = links.groupBy("node").agg(F.collect_list("near").alias("near"))
    kind = F.when(F.size("near") < NEIGHBOURS, "few").otherwise("many")
    sampled = counts.select("node", F.explode("near").alias("near"), kind.alias("kind"))
    return written(sampled.union(plants.select("node", -1 - F.col("node"), F.lit("planted"))), "audit-links")


def _least_share(links: DataFrame) -> float:
    """The share of ``held`` ones of the audited links, of the kind with the least."""
    shares = links.groupBy("kind").agg(F.avg(F.coalesce("held", F.lit(False)).cast("double")).alias("share")).collect()
    return min((r["share"] for r in shares), default=1.0)


def _audit(links: DataFrame, graph: DataFrame) -> float:
    """The share of ``links`` that the graph holds on either side.

    Nodes whose list is full of links are left out here: ``_grouped`` judges them by the groups.
    """
    held = graph.select("node", "near").union(graph.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct()
    full = graph.where(F.col("score") >= THRESHOLD).groupBy("node").count().where(F.col("count") >= NEIGHBOURS).select("node")
    return _least_share(links.join(full, "node", "left_anti").join(held.withColumn("held", F.lit(True)), ["node", "near"], "left"))


def _grouped(links: DataFrame, groups: DataFrame) -> float:
    """The share of ``links`` with both ends in one group, where they are compared."""
    ends = [groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group")) for c in ("node", "near")]
    return _least_share(links.join(ends[0], "node", "left").join(ends[1], "near", "left").withColumn(
        "held", F.col("node_group") == F.col("near_group")))


def neighbour_graph(
    vertices: DataFrame, links: DataFrame | None = None, graph: DataFrame | None = None, turn: int = 0,
) -> DataFrame:
    """(node, near, score, fresh) for ``vertices`` (node, label, unit, half): neighbours of the same label only.

    Starts from hyperplane buckets, and from ``graph`` if one is given, and descends until a round brings less than
    ``FEW_EDGES`` new edges and the graph holds ``TARGET_RECALL`` of the audited ``links``, or for ``MOST_ROUNDS``.
    A descent that has settled below the target gets the buckets of other hyperplanes: what one draw of planes parts,
    another one brings together. A list with nothing but links is saturated: it may hide more of them, so it is
    enlarged twofold each round, up to ``MOST_NEIGHBOURS``.
    """
    n = vertices.count()
    if links is None:
        links = true_links(vertices, vertices.limit(0))
    centres = written(_centres(vertices), "descent-centres")
    proposed = _bucketed(vertices, centres, n, turn)
    if graph is not None:
        proposed = proposed.unionByName(graph.withColumn("fresh", F.lit(False)))
    graph = written(_best(proposed, None), "descent-graph")
    wanted = graph.select("node", F.lit(NEIGHBOURS).alias("list")).limit(0)
    settled = False
    for _ in range(MOST_ROUNDS):
        full = graph.where(F.col("score") >= THRESHOLD).groupBy("node").agg(F.count("*").alias("links"))
        wanted = written(full.join(wanted, "node", "left").select(
            "node", "links", F.coalesce("list", F.lit(NEIGHBOURS)).alias("list")).where("links >= list").select(
            "node", F.least(F.col("list") * 2, F.lit(MOST_NEIGHBOURS)).alias("list")), "descent-lists")
        proposed = _descend(graph, vertices, wanted)
        if settled:
            turn += 1
            proposed = proposed.unionByName(_bucketed(vertices, centres, n, turn))
        graph = written(_best(proposed, wanted), "descent-graph")
        edges = graph.agg(F.count("*").alias("all"), F.count_if("fresh").alias("fresh")).first()
        settled = edges["fresh"] <= FEW_EDGES * edges["all"]
        if settled and _audit(links, graph) >= TARGET_RECALL:
            break
    return graph


def _angles(units: Column, others: Column) -> Column:
    @F.arrow_udf("double")
    def angles(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            pairs = [tuple(np.frombuffer(u.as_buffer(), "<f8") for u in pair) for pair in zip(*batch)]
            yield pa.array([float(np.arccos(np.clip(a @ b, -1, 1))) for a, b in pairs], pa.float64())

    return angles(units, others)


def _meeting(left: list[tuple], right: list[tuple]) -> Iterator[tuple]:
    """Edges that connect components (component, unit, radius) whose members may be linked by the triangle inequality."""
    own, names = _matrix([r[1] for r in left]), [r[0] for r in left + right]
    others, radii = _matrix([r[1] for r in right]) if right else own, np.array([r[2] for r in left + right])
    reach = radii[:len(left), None] + (radii[len(left):] if right else radii) + np.arccos(THRESHOLD) + ANGLE_ERROR
    linked = np.arccos(np.clip(own @ others.T, -1, 1)) <= reach
    for i, root in spanning(square(linked) if right else linked):
        yield names[i], names[root]


def full_meetings(graph: DataFrame, groups: DataFrame, vertices: DataFrame) -> DataFrame:
    """(a, b): edges between components with full lists that could be linked.

    A node with ``NEIGHBOURS`` links or more may have further ones that its list has no place for, also into
    another component of such nodes. Each of these components has a representative, and a radius: the largest
    angle of a member to it. Pairs of representatives are bounded in blocks; what the bound doesn't rule out is
    to be compared exactly. Links of other nodes are in their lists.
    """
    full = graph.where(F.col("score") >= THRESHOLD - HALF_ERROR).groupBy("node").count().where(F.col("count") >= NEIGHBOURS)
    crowded = groups.join(full.select("node"), "node", "left_semi").select("component").distinct()
    members = groups.join(crowded, "component", "left_semi")
    units = vertices.select("node", "label", "unit")
    heads = crowded.join(units, F.col("component") == F.col("node")).select("component", "label", F.col("unit").alias("head"))
    radii = members.join(units.select("node", "unit"), "node").join(heads.select("component", "head"), "component").groupBy(
        "component").agg(F.max(_angles(F.col("unit"), F.col("head"))).alias("radius"))
    balls = written(heads.join(radii, "component").select("component", "label", "head", "radius"), "vector-balls")
    return by_pair(in_blocks(balls, "label", "component", BLOCK).select("pair", "side", "component", "head", "radius"),
                   _meeting, "a long, b long", ["a", "b"], [pa.int64()] * 2)


def _verify(left: list[tuple], right: list[tuple]) -> Iterator[tuple]:
    """Links in double precision between two blocks: per node the rows it links with, and connecting edges."""
    nodes, weights = [r[0] for r in left + right], np.array([r[1] for r in left + right])
    own = _matrix([r[2] for r in left])
    linked = (own @ (_matrix([r[2] for r in right]) if right else own).T) >= THRESHOLD
    if right:
        links = np.concatenate([linked @ weights[len(left):], weights[:len(left)] @ linked])
        linked = square(linked)
    else:
        np.fill_diagonal(linked, False)
        links = linked @ weights
    roots = dict(spanning(linked))
    for i in np.flatnonzero(links):
        yield nodes[i], nodes[roots.get(int(i), int(i))], int(links[i])


def link_groups(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): nodes that edges of the neighbour graph near the threshold, or full lists, bring together.

    The search goes on with other hyperplanes until the groups hold ``TARGET_RECALL`` of the audited ``links``. After
    ``MOST_SEARCHES`` searches below that it is an error: links are not dropped unseen, and no label is compared in full.
    """
    graph = None
    for search in range(MOST_SEARCHES):
        graph = neighbour_graph(vertices, links, graph, search * (MOST_ROUNDS + 1))
        near = graph.where(F.col("score") >= THRESHOLD - HALF_ERROR).select(F.col("node").alias("a"), F.col("near").alias("b"))
        groups = components(near, "vector-groups")
        meetings = written(full_meetings(graph, groups, vertices), "vector-meetings")
        if meetings.limit(1).count():
            groups = components(near.union(meetings), "vector-groups")
        recall = _grouped(links, groups)
        if recall >= TARGET_RECALL:
            return groups
    raise RuntimeError(f"the neighbour search holds {recall:.4f} of the audited links, less than {TARGET_RECALL}")


def vector_links(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Two rows are linked if their labels are equal and their cosine, in double precision, is at least
    ``THRESHOLD``. Equal vectors of a label are one node with as many rows. Edges of the neighbour graph near
    the threshold group the nodes, and groups with full lists are joined where their radii allow a link between
    them; in each group all nodes are compared in blocks, so a full list costs no link, and no pair of rows is
    made for each pair of a group. The search is judged by links of sampled nodes and by planted copies, which take
    part in it alone, and goes on until it finds them. ``component_id`` is the smallest vec_id reachable.
    Rows whose label is null or whose vector is null, zero or holds null or non-finite components are alone.
    """
    rows = written(vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.size("embedding").alias("width"),
                                  unit(F.col("label"), F.col("embedding")).alias("u")).select(
        "vec_id", F.concat_ws(":", "label", F.col("width").cast("string")).alias("label"), "u.key", "u.unit"), "vector-rows")
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.count("*").alias("rows"), F.min("vec_id").alias("first_id"), F.first("label").alias("label"), F.first("unit").alias("unit"))
    vertices = written(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn(
        "half", _half(F.col("unit"))), "vector-nodes")
    searched = vertices.select("node", "label", "unit", "half")
    plants = written(planted(searched), "vector-plants")
    groups = link_groups(searched.unionByName(plants), true_links(searched, plants))
    members = groups.join(vertices.select("node", "rows", "unit"), "node")  # plants are no vertices
    verified = written(by_pair(
        in_blocks(members, "component", "node", BLOCK).select("pair", "side", "node", "rows", "unit"), _verify,
        "node long, root long, links long", ["node", "root", "links"], [pa.int64()] * 3), "vector-links")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-classes")
    known = written(vertices.select("node", "key", "rows", "first_id").join(links, "node", "left").join(classes, "node", "left").select(
        "key", "first_id", F.coalesce("component", "node").alias("class"),
        (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-known")
    firsts = known.groupBy("class").agg(F.min("first_id").alias("component_id"))
    found = rows.select("vec_id", "key").join(known.join(firsts, "class").select("key", "n_links", "component_id"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


@query("op4_nn_descent")
def op4_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links(table(spark, folder, "embeddings"))
