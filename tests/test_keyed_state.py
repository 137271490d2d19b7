"""Bucketed state: batches against the plain operators, restarts, compaction, and what a batch writes and reads."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import upserts as U
from quire.plans import ingest_run, keyed_ingest
from quire.plans.keyed_state import KeyedState
from test_ingest import at, no_broadcast, pubs  # noqa: F401

ROWS = "k long, v string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def held(state, before=None):
    return sorted((r.k, r.v) for r in state.read(before).collect())


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_versions_replace_keys_and_repeats_change_nothing(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), ROWS, ["k"], 4)
    assert held(state) == [] and state.lookup(rows(spark, (1, "x"))).isEmpty()
    assert state.write(rows(spark, (1, "a"), (1, "b"), (2, "c"), (3, "d")), 5)
    assert state.write(rows(spark, (1, "e")), 6, keys=spark.createDataFrame([(2,), (9,)], "k long"))
    assert held(state) == [(1, "e"), (3, "d")] and held(state, before=6) == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]
    assert not state.write(rows(spark, (3, "never")), 6) and held(KeyedState(spark, str(tmp_path), ROWS, ["k"], 4)) == held(state)
    assert state.write(rows(spark), 7) and held(state) == [(1, "e"), (3, "d")]


def test_a_failed_write_is_no_version(spark, tmp_path, monkeypatch):
    state = KeyedState(spark, str(tmp_path), ROWS, ["k"], 4)
    state.write(rows(spark, (1, "a")), 0)
    with monkeypatch.context() as m:
        m.setattr(KeyedState, "_record", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.write(rows(spark, (1, "lost"), (2, "lost")), 1)
    assert held(state) == [(1, "a")]
    assert state.write(rows(spark, (1, "b")), 1) and held(state) == [(1, "b")]


def test_lookups_read_only_their_buckets_and_do_not_shuffle_the_state(spark, tmp_path, no_broadcast):  # noqa: F811
    state = KeyedState(spark, str(tmp_path), ROWS, ["k"], 8)
    state.write(spark.range(400).selectExpr("id k", "'old' v"), 0)
    state.write(spark.range(0, 400, 7).selectExpr("id k", "'new' v"), 1)
    found = state.lookup(spark.createDataFrame([(7,), (8,), (900,)], "k long"))
    assert sorted((r.k, r.v) for r in found.collect()) == [(7, "new"), (8, "old")]
    for frame, most in ((found, 6), (state.read(), 16)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
        scans = [i for i, x in enumerate(lines) if "FileScan" in x]
        assert scans
        for i in scans:
            assert "Bucketed: true" in lines[i]
            at_depth, above = depth[i], i
            while above > 0:
                above = max((j for j in range(above) if depth[j] < at_depth), default=0)
                at_depth = depth[above]
                assert "Exchange" not in lines[above], plan
        assert len(frame.inputFiles()) <= most


def test_compaction_rewrites_only_buckets_with_many_deltas(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), ROWS, ["k"], 8)
    expected = {i: "0" for i in range(200)}
    state.write(spark.range(200).selectExpr("id k", "'0' v"), 0)
    for version in range(1, 7):
        state.write(spark.createDataFrame([(3, str(version)), (version * 11, str(version))], ROWS), version)
        expected |= {3: str(version), version * 11: str(version)}
    before = files(tmp_path)
    assert not state.compact(least=50) and files(tmp_path) == before
    assert state.compact(least=5, keep=1)
    after = files(tmp_path)
    fresh = {name for name in after if "base=" in name}
    assert {name.split("g=")[1].split("/")[0] for name in fresh} <= {name.split("g=")[1].split("/")[0] for name in before}
    assert 0 < len({name.split("g=")[1].split("/")[0] for name in fresh}) < 4
    assert held(state) == sorted(expected.items())
    older = dict(held(state, before=6))
    assert older[3] == "5" and older[66] == "0"
    for version in range(7, 20):
        state.write(rows(spark, (3, str(version))), version)
    state.compact(least=2, keep=1)
    assert dict(held(state))[3] == "19" and len(files(tmp_path)) < len(after) + 13
    with pytest.raises(ValueError, match="removed"):
        state.read(before=3)


def test_keyed_inserts_and_replacements(spark, tmp_path):
    raw = KeyedState(spark, str(tmp_path / "raw"), "sha256 string, id string, created_at int", ["sha256"], 4)
    kind = "sha256 string, id string, created_at int"
    first = spark.createDataFrame([("a", "1", 2), ("a", "0", 3), ("b", "2", 1)], kind)
    second = spark.createDataFrame([("a", "9", 0), ("c", "4", 5), ("c", "3", 5)], kind)
    keyed_ingest.insert_into(raw, first, ["created_at", "id"], 1)
    keyed_ingest.insert_into(raw, second, ["created_at", "id"], 2)
    keyed_ingest.insert_into(raw, second, ["created_at", "id"], 2)
    assert sorted(map(tuple, raw.read().collect())) == [("a", "1", 2), ("b", "2", 1), ("c", "3", 5)]
    pages = KeyedState(spark, str(tmp_path / "pages"), "document_id int, page int", ["document_id"], 4)
    keyed_ingest.replace_in(pages, spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "document_id int, page int"), 0)
    kept = files(tmp_path / "pages")
    done = spark.createDataFrame([(1,), (3,)], "document_id int")
    for _ in range(2):
        keyed_ingest.replace_in(pages, spark.createDataFrame([(1, 7)], "document_id int, page int"), 1, processed=done)
        assert sorted(map(tuple, pages.read().collect())) == [(1, 7), (2, 1)]
    assert {k: v for k, v in files(tmp_path / "pages").items() if k in kept} == kept


SHOWN = ["source_document_id", "parent_publication_id", "is_latest_version", "needs_review", "title", "root_id"]


def shown(df):
    return sorted((tuple(r) for r in df.select(*SHOWN).collect()), key=repr)


def feed(seed, size=60):
    """Chains, stars, corrections, cycles and rows that name nothing there is, in any order."""
    rng = random.Random(seed)
    out = []
    for i in range(1, size + 1):
        kind = rng.random()
        parent = None if kind < 0.25 else "missing" if kind < 0.32 else f"d{rng.randint(max(1, i - 9), min(size, i + 3))}"
        when = None if rng.random() < 0.1 else dt.datetime(2024, 1, rng.randint(1, 9))
        out.append((i, f"d{i}", parent, rng.random() < 0.3, when))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_of_publications_give_what_one_run_gives(spark, tmp_path, seed):
    everything = feed(seed)
    whole = pubs(spark, everything)
    state = keyed_ingest.PublicationState(spark, str(tmp_path), whole.drop("seq").schema, 4)
    cuts = [0, 25, 26, 48, 60]
    for version, (start, end) in enumerate(zip(cuts, cuts[1:])):
        batch = pubs(spark, everything[start:end])
        if version == 3:  # some rows come again with another title
            batch = batch.unionByName(pubs(spark, everything[:3]).withColumn("title", F.lit("again")))
        assert state.apply(batch, at(spark), version)
    final = whole.withColumn("title", F.when(F.col("id").isin([r[0] for r in everything[:3]]), "again").otherwise(F.col("title")))
    expected = ingest_run.publish(whole.drop("seq").limit(0), final, at(spark))
    assert shown(state.read()) == shown(expected)
    before = files(tmp_path)
    assert not state.apply(pubs(spark, everything[:9]), at(spark), 3) and files(tmp_path) == before
    state.compact(least=2)
    assert shown(state.read()) == shown(expected)


def test_a_batch_writes_its_own_lineages(spark, tmp_path):
    chains = [(i, f"d{i}", f"d{i - 1}" if i % 5 else None, False, dt.datetime(2024, 1, 1)) for i in range(500)]
    state = keyed_ingest.PublicationState(spark, str(tmp_path), pubs(spark, chains[:1]).drop("seq").schema, 8)
    state.apply(pubs(spark, chains), at(spark), 0)
    state.apply(pubs(spark, [(900, "late", "d14", False, dt.datetime(2024, 2, 1))]), at(spark), 1)
    delta = spark.read.parquet(str(tmp_path / "publications" / "v=1"))
    assert {r.source_document_id for r in delta.collect()} == {"late", "d14"}
    assert spark.read.parquet(str(tmp_path / "members" / "v=1")).count() == 6
    latest = {r.source_document_id for r in state.read().where("is_latest_version").collect()}
    assert "late" in latest and "d14" not in latest and len(latest) == 100


def test_an_insert_is_dealt_by_the_shuffle_that_finds_the_first_of_a_key(spark, tmp_path, monkeypatch):
    from quire.plans import keyed_ingest

    state = KeyedState(spark, str(tmp_path / "dealt"), "k int, v string", ["k"], buckets=8)
    keyed_ingest.insert_into(state, spark.range(0, 500).selectExpr("cast(id % 100 as int) k", "cast(id as string) v"), ["v"], 0)
    plans, put = [], KeyedState._put

    def watched(self, rows, folder, dealt=False):
        plans.append((dealt, rows._jdf.queryExecution().executedPlan().toString()))
        return put(self, rows, folder, dealt)

    monkeypatch.setattr(KeyedState, "_put", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed_ingest.insert_into(state, spark.range(50, 900).selectExpr("cast(id % 300 as int) k", "cast(id as string) v"), ["v"], 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (dealt, plan), = plans
    assert dealt and plan.count("Exchange hashpartitioning(k") == plan.count("Exchange") == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    rows = {r.k: r.v for r in state.read().collect()}
    assert len(rows) == 300 and rows[7] == "107" and rows[250] == "250" and state.read().count() == 300
    # A bucket is one file of a version.
    for version in ("v=0", "v=1"):
        assert all(len(list(g.glob("*.parquet"))) == 1 for g in (tmp_path / "dealt" / version).glob("g=*"))
