"""Neighbour graphs and nearest neighbours against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import descent, multi_index
from quire.llm.vectors import kmeans

SCHEMA = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


def vector_rows(n=400, width=16, seed=1):
    """Random vectors; pairs and groups of near copies, exact copies, ties; rows that take no part."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(width).astype("f4").tolist(), int(i % 3)) for i in range(n)]
    for i in range(0, 60, 3):
        rows.append((1000 + i, (np.array(rows[i][1]) + 0.01 * rng.standard_normal(width)).astype("f4").tolist(), rows[i][2]))
    centre = rng.standard_normal(width)
    for i in range(90):
        rows.append((2000 + i, (centre + 0.02 * rng.standard_normal(width)).astype("f4").tolist(), 1))
    rows += [(3000 + i, rows[5][1], rows[5][2]) for i in range(20)]
    rows += [(3100, rows[5][1], 0), (3101, rows[5][1], None), (3102, rows[5][1], 2), (3102, rows[5][1], 2)]
    rows += [(3200, None, 1), (3201, [0.0] * width, 1), (3202, [NAN] + [1.0] * (width - 1), 1),
             (3203, [INF] + [1.0] * (width - 1), 1), (3204, [None] + [1.0] * (width - 1), 1), (3205, [], 1),
             (3206, [1.0, 2.0], 1), (3207, [2.0, 4.0], 1), (None, rows[7][1], rows[7][2])]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v)


def brute_links(rows):
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) and label is not None else None
             for _, v, label in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
            continue
        if units[i] @ units[j] >= 0.98:
            links[i] += 1
            links[j] += 1
            parent[find(j)] = find(i)
    smallest = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), row[0]), row[0])
    return sorted(((r[0], links[i], smallest.get(find(i)), r[0] is not None and r[0] == smallest.get(find(i)))
                   for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [512, 16])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(descent, "BLOCK", block)
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("node", "unit", "rows", "kept", "key")})
    got = sorted(map(tuple, descent.vector_links(vectors.repartition(3)).collect()), key=repr)
    assert got == brute_links(rows)


def test_saturated_lists_grow(spark):
    rows = [r for r in vector_rows() if usable(r[1]) and r[2] is not None and len(r[1]) == 16]
    units = [np.array(v, "f8") / np.linalg.norm(np.array(v, "f8")) for _, v, _ in rows]
    vertices = spark.createDataFrame(
        [(i, str(r[2]), u.tobytes(), u.astype("<f2").tobytes()) for i, (r, u) in enumerate(zip(rows, units))],
        "node long, label string, unit binary, half binary")
    sizes = {r["node"]: r["count"] for r in descent.neighbour_graph(vertices).groupBy("node").count().collect()}
    group = [i for i, r in enumerate(rows) if r[0] is not None and 2000 <= r[0] < 2100]
    assert np.median([sizes[i] for i in group]) > descent.NEIGHBOURS
    assert max(sizes.values()) <= descent.MOST_NEIGHBOURS


def test_full_lists_hide_no_link_between_groups(spark):
    """Two groups of near copies, cosines about 0.998 inside and 0.984 across: lists are full of the own group."""
    rng = np.random.default_rng(8)
    first = np.eye(64)[0]
    second = 0.986 * first + np.sqrt(1 - 0.986 ** 2) * np.eye(64)[1]
    rows = [(i, ((first, second)[i % 2] + 0.005 * rng.standard_normal(64)).astype("f4").tolist(), 1) for i in range(240)]
    rows += [(1000 + i, rng.standard_normal(64).astype("f4").tolist(), 1) for i in range(20)]
    want = brute_links(rows)
    assert len({component for i, _, component, _ in want if i < 1000}) == 1
    assert sorted(map(tuple, descent.vector_links(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == want


def test_rare_links_are_found(spark, monkeypatch):
    """Pairs far apart in a cone of crowded directions; the first sample holds none of their links."""
    for name, value in (("AUDITED", 2), ("MOST_AUDITED", 16), ("BUCKET", 4), ("TABLES", 1)):
        monkeypatch.setattr(descent, name, value, raising=False)
    rng = np.random.default_rng(11)
    centre = 3 * np.eye(48)[0]
    rows = [(i, (centre + rng.standard_normal(48)).astype("f4").tolist(), 1) for i in range(1500)]
    rows += [(5000 + i, (np.array(rows[i][1]) + 0.02 * rng.standard_normal(48)).astype("f4").tolist(), 1) for i in range(12)]
    assert sorted(map(tuple, descent.vector_links(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == brute_links(rows)


def test_one_link_among_many_rows(spark):
    """A cone of crowded directions with three pairs; each label is searched, none is compared in full."""
    rng = np.random.default_rng(12)
    vectors = (8 * np.eye(32)[0] + 2 * rng.standard_normal((12_000, 32))).astype("f4")
    for i in range(3):
        vectors[100 + i] = vectors[i] + 0.2 * rng.standard_normal(32)
    units = vectors.astype("f8") / np.linalg.norm(vectors.astype("f8"), axis=1)[:, None]
    want = {}
    for at in range(0, len(units), 1000):
        for i, j in zip(*np.nonzero(units[at:at + 1000] @ units.T >= 0.98)):
            if at + i != j:
                want.setdefault(int(at + i), []).append(int(j))
    assert 6 <= len(want) < 60
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    got = descent.vector_links(spark.createDataFrame(rows, SCHEMA))
    assert {r["vec_id"]: r["n_links"] for r in got.where("n_links > 0").collect()} == {i: len(j) for i, j in want.items()}
    assert got.count() == len(rows)


def test_plants_are_copies_within_the_threshold(spark):
    units = np.eye(40)
    vertices = spark.createDataFrame([(i, "1", u.tobytes()) for i, u in enumerate(units)], "node long, label string, unit binary")
    vertices = vertices.withColumn("half", descent._half(F.col("unit")))
    plants = descent.planted(vertices)
    found = {r["node"]: np.frombuffer(r["unit"], "<f8") for r in plants.collect()}
    assert sorted(found) == list(range(-40, 0))
    assert all(0.98 < units[-1 - node] @ unit < 0.9991 for node, unit in found.items())
    links = descent.true_links(vertices, plants).collect()
    assert sorted(map(tuple, links)) == [(-1 - i, i, "planted") for i in range(39, -1, -1)]
    alone = spark.createDataFrame([(0, "1", np.ones(1).tobytes())], "node long, label string, unit binary")
    assert descent.planted(alone).first()["unit"] == np.ones(1).tobytes()


def test_a_search_below_its_target_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(descent, "_grouped", lambda links, groups: 0.5)
    monkeypatch.setattr(descent, "MOST_SEARCHES", 1)
    rows = [(i, np.eye(8)[i].tolist(), 1) for i in range(8)]
    with pytest.raises(RuntimeError, match="0.5000"):
        descent.vector_links(spark.createDataFrame(rows, SCHEMA))


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert descent.vector_links(nothing).count() == 0
    assert multi_index.nearest_neighbours(nothing, nothing).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], SCHEMA)
    assert descent.vector_links(bad).where("kept and n_links = 0").count() == 2
    assert multi_index.nearest_neighbours(bad, bad).count() == 0


def test_cells_are_walked_by_summed_distance():
    rng = np.random.default_rng(2)
    books = multi_index.Books(kmeans(rng.standard_normal((50, 3)), 7), kmeans(rng.standard_normal((50, 2)), 5))
    for _ in range(20):
        vector = rng.standard_normal(5)
        a, b = (d[0] for d in books.halves(vector[None]))
        cells = list(books.traversal(vector))
        assert sorted(cells) == list(range(35))
        sums = [a[c // 5] + b[c % 5] for c in cells]
        assert (np.diff(sums) >= -1e-12).all()


@pytest.mark.parametrize("small", [False, True])
def test_nearest_neighbours_reach_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, large cells over several of them, queries in parts
        monkeypatch.setattr(multi_index, "ENTRIES_PER_BLOCK", 32)
        monkeypatch.setattr(multi_index, "QUERIES_PER_BLOCK", 8)
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("cell", "ids", "rank", "score", "block")})
    queries = vectors.where("vec_id % 10 = 0")
    got = {}
    for row in multi_index.nearest_neighbours(vectors.repartition(3), queries).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.score, row.vec_id))
    usual = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and usable(v) and len(v) == 16]
    hits = total = 0
    asked = {i: v for i, v in usual if i % 10 == 0}
    other = {i: got.pop(i) for i, v, _ in rows if usable(v) and len(v) == 2 and i in got}
    assert set(other) == {i for i, v, _ in rows if usable(v) and len(v) == 2 and i % 10 == 0}
    assert set(got) == set(asked)
    for i, query in asked.items():
        want = sorted((float(np.sqrt(((v - query) ** 2).sum())), j) for j, v in usual if j != i)[:10]
        found = sorted(got[i])
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, j) for _, s, j in found] == sorted((s, j) for _, s, j in found)
        truth = {(round(s, 9), j) for s, j in want}
        hits += sum((round(s, 9), j) in truth for _, s, j in found)
        total += 10
    assert hits / total >= 0.9


def test_each_width_has_its_own_index(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4 if i % 2 else 6).tolist(), 1) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for row in multi_index.nearest_neighbours(vectors, vectors.where("vec_id < 9")).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    hits = 0
    for i in range(9):
        near = sorted((float(np.linalg.norm(np.array(rows[i][1]) - np.array(v))), j) for j, v, _ in rows
                      if j != i and len(v) == len(rows[i][1]))[:10]
        assert len(got[i]) == 10 and all(j % 2 == i % 2 for j in got[i])
        hits += sum(j in got[i] for _, j in near)
    assert hits >= 81


def test_a_walk_sees_more_than_it_is_asked_for(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "_audit", lambda *a: 1)
    rows = [(i, [float(i), 1.0 + i % 7], 1) for i in range(200)] + [(1000 + i, [5000.0, 1.0], 1) for i in range(50)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = multi_index.nearest_neighbours(vectors, vectors.where("vec_id % 10 = 0"))
    assert found.groupBy("query_id").count().where("count <> 10").isEmpty()


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in multi_index.nearest_neighbours(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()]
    assert [(r[1], r[2]) for r in got] == [(1, 100), (2, 2), (3, 3)] and got[0][3] == 0.0
