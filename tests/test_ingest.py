"""Publications, versions and jobs on literal input, and invariants that must hold."""

import pytest
from pyspark.sql import functions as F

from quire.operators import ingest as I
from quire.operators import jobs as J
from quire.operators import lineage as L
from quire.operators import pages as P
from quire.operators import upserts as U
from quire.plans import ingest_run, snapshots

PUB = ("id int, source string, source_document_id string, supersedes string, is_correction boolean, title string, "
       "document_type string, published_at timestamp_ntz, source_updated_date date, published_at_precision string, "
       "scope string, audit_status string, language string, source_reference string, updated_at timestamp_ntz")


def pubs(spark, rows):
    filled = [(i, "S", key, parent, fix, "t", "other", when, None, None, "unknown", "unknown", None, None, None)
              for i, key, parent, fix, when in rows]
    return U.publication_flags(spark.createDataFrame(filled, PUB)).withColumn("seq", F.col("id"))


def at(spark):
    return F.lit("2030-01-01").cast("timestamp_ntz")


def publish(spark, root, version, state, batch):
    """One batch written as a snapshot, as a run does, and read back."""
    merged = ingest_run.publish(state, batch, at(spark))
    columns = dict.fromkeys([*state.columns, "needs_review", "created"])
    snapshots.write_snapshot(merged.select(*columns), f"{root}/{version}", 0)
    return snapshots.read_snapshot(spark, f"{root}/{version}")


def outcome(df):
    return {r.source_document_id: (r.is_latest_version, r.parent_publication_id, r.needs_review) for r in df.collect()}


def test_chain_in_any_order_gives_the_same_versions(spark, tmp_path):
    import datetime as dt
    same = dt.datetime(2024, 4, 20)
    rows = [(3, "v3", "v2", True, same), (2, "v2", "v1", True, same), (1, "v1", None, False, same),
            (4, "lost", "nowhere", False, same), (5, "orphan", None, True, same)]
    expected = {"v1": (False, None, False), "v2": (False, 1, False), "v3": (True, 2, False),
                "lost": (False, None, True), "orphan": (False, None, True)}
    everything = pubs(spark, rows)
    empty = everything.drop("seq").limit(0)
    root = str(tmp_path)
    assert outcome(publish(spark, root, "whole", empty, everything)) == expected
    first = publish(spark, root, "first", empty, everything.where("id IN (3, 4)")).drop("created")
    second = publish(spark, root, "second", first, everything.where("id NOT IN (3, 4)")).drop("created")
    assert outcome(second) == expected
    again = publish(spark, root, "again", second, everything)
    assert outcome(again) == expected and again.where("created").isEmpty()


def test_latest_leaf_prefers_unknown_time_then_text_id(spark):
    import datetime as dt
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    rows = [(1, "a", None, False, early), (2, "b", "a", False, late), (3, "c", "a", False, None),
            (10, "x", None, False, early), (9, "y", "x", False, late), (11, "z", "x", False, late)]
    linked = L.link_predecessors(pubs(spark, rows))
    flagged = L.latest_leaf_flag(linked, L.lineage_closure(linked))
    assert {r.source_document_id for r in flagged.where("is_latest_version").collect()} == {"c", "y"}


def test_closure_of_long_chains_wide_stars_and_cycles(spark):
    chain = [(i, i - 1 if i else None) for i in range(300)]
    star = [(1000 + i, 1000 if i else None) for i in range(300)]
    cycle = [(5000, 5001), (5001, 5002), (5002, 5000), (5003, 5000)]
    edges = spark.createDataFrame(chain + star + cycle, "id int, parent_publication_id int")
    got = {r.id: (r.root_id, r.depth) for r in L.lineage_closure(edges).collect()}
    assert all(got[i] == (0, i) for i in range(300))
    assert all(got[1000 + i] == (1000, min(i, 1)) for i in range(300))
    assert all(got[i] == (None, None) for i in range(5000, 5004))


def test_a_cycle_costs_no_more_rounds_than_the_longest_chain(spark, monkeypatch):
    cuts, cut = [], L.stored_by
    monkeypatch.setattr(L, "stored_by", lambda *a: cuts.append(1) or cut(*a))
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, None), (4, 3), (5, 9)], "id int, parent_publication_id int")
    got = {r.id: (r.root_id, r.depth) for r in L.lineage_closure(edges).collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (3, 0), 4: (3, 1), 5: (9, 1)}
    assert len(cuts) <= 3


def labels_of(df):
    return {r.id: (r.root_id, r.depth) for r in df.collect()}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_found_rows_are_not_shuffled_again(spark, monkeypatch, no_broadcast):
    plans, laid = [], L.stored_by
    monkeypatch.setattr(L, "stored_by", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or laid(df, *a))
    edges = spark.createDataFrame([(i, i - 1 if i else None) for i in range(40)], "id int, parent_publication_id int")
    assert labels_of(L.lineage_closure(edges)) == {i: (0, i) for i in range(40)}
    lines = plans[-1].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    bucketed = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(bucketed) >= 5
    for i in bucketed:  # from a scan up to the join there is no exchange
        above, at = i, depth[i]
        while "Join" not in lines[above]:
            assert "Exchange" not in lines[above]
            above = max(j for j in range(above) if depth[j] < at)
            at = depth[above]


def test_a_batch_of_edges_extends_a_closure(spark):
    kind = "id int, parent_publication_id int"
    old = [(1, None), (2, 1), (3, 2), (10, None), (11, 10), (12, 11), (20, 99), (30, 31), (31, 30), (32, 31), (40, None), (41, 40)]
    # 13 follows 12; 10 turns out to follow 3, which joins two lineages; 99 arrives and follows 50, a new root;
    # 33 hangs on a cycle; 40 turns out to follow its own successor; 60 follows a row that nobody knows.
    batch = [(13, 12), (14, 13), (10, 3), (50, None), (99, 50), (33, 32), (40, 41), (42, 41), (60, 61)]
    labels = L.lineage_closure(spark.createDataFrame(old, kind))
    found, moved = L.extend_closure(labels, spark.createDataFrame(batch, kind))
    known = {i for i, _ in old}
    got = labels_of(L.moved_labels(labels, moved).unionByName(found.where(~F.col("id").isin(*known))))
    everything = dict(old) | dict(batch)
    assert got == labels_of(L.lineage_closure(spark.createDataFrame(list(everything.items()), kind)))
    assert got[14] == (1, 7) and got[20] == (50, 2) and got[33] == got[42] == got[41] == (None, None) and got[60] == (61, 1)


def test_extending_by_nothing_and_from_nothing(spark):
    kind = "id int, parent_publication_id int"
    labels = L.lineage_closure(spark.createDataFrame([(1, None), (2, 1)], kind))
    found, moved = L.extend_closure(labels, spark.createDataFrame([], kind))
    assert found.isEmpty() and labels_of(L.moved_labels(labels, moved)) == {1: (1, 0), 2: (1, 1)}
    nothing = L.lineage_closure(spark.createDataFrame([], kind))
    found, _ = L.extend_closure(nothing, spark.createDataFrame([(1, 2), (2, None)], kind))
    assert labels_of(found) == {1: (2, 1), 2: (2, 0)}


def test_orders_of_company_listings(spark):
    import datetime as dt
    t = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    pubs = spark.createDataFrame([(1, 7, t[1]), (2, 7, t[2]), (3, 7, t[2]), (4, 7, t[0]), (5, 6, t[1])],
                                 "id int, company_id int, published_at timestamp_ntz")
    assert [r.id for r in I.company_documents_newest(pubs).collect()] == [5, 4, 3, 2, 1]
    artifacts = spark.createDataFrame([(10, 1, t[1]), (11, 2, t[2]), (12, 3, t[2]), (13, 5, t[1])],
                                      "id int, publication_id int, created_at timestamp_ntz")
    assert [r.id for r in I.company_artifacts(artifacts, pubs).collect()] == [13, 12, 11, 10]
    assert [r.id for r in I.company_artifacts(artifacts, pubs, 7).collect()] == [12, 11, 10]


def test_orders_of_pages_and_blocks(spark):
    rows = [(2, 1, 0), (1, 10, 1), (1, 2, 5), (1, 10, 0), (1, 2, 4), (2, 1, 3)]
    blocks = spark.createDataFrame(rows, "document_id int, page_number int, block_index int").repartition(5)
    assert [tuple(r) for r in P.blocks_in_order(blocks).collect()] == sorted(rows)
    pages = blocks.select("document_id", "page_number").distinct().repartition(5)
    assert [tuple(r) for r in P.pages_in_order(pages).collect()] == [(1, 2), (1, 10), (2, 1)]


def test_discover_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "pubs")
    spark.sql("SELECT 'FPT' AS ticker, timestamp_ntz'2024-04-20 23:30:00' AS published_at UNION ALL "
              "SELECT 'fpt', timestamp_ntz'2024-04-21 00:00:00'").write.parquet(path)
    stored = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    found = I.discover(stored, "FPT", "2024-04-20", "2024-04-20", stored_upper=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(published_at" in plan and "GreaterThanOrEqual(published_at" in plan and "EqualTo(ticker,FPT)" in plan
    assert found.count() == 1 and I.discover(stored, "fpt").count() == 2


def test_block_content_is_a_json_object(spark):
    texts = ["{broken}", '{"a": 1}', "[1]", "", None, "7", ' {"b": {}} ', "{}"]
    blocks = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "block_index int, content string").withColumns(
        {c: F.lit(None).cast("double") for c in ("bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1")})
    bad = {r.block_index for r in I.check_block_rows(blocks).where("array_contains(violations, 'content')").collect()}
    assert bad == {0, 2, 3, 4, 5}


def test_versions_as_of_a_table(spark):
    import datetime as dt
    pubs = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), None), (2, 1, dt.datetime(2024, 2, 1), None),
                                  (3, 3, None, dt.date(2024, 1, 15))],
                                 "id int, root_id int, published_at timestamp_ntz, source_updated_date date")
    asked = spark.createDataFrame([(1, "2024-01-20"), (1, "2024-03-01"), (3, "2024-01-01"), (3, "2024-01-15")], "root_id int, as_of string")
    got = {(r.root_id, r.as_of, r.id) for r in L.as_of_versions(pubs, asked).collect()}
    assert got == {(1, "2024-01-20", 1), (1, "2024-03-01", 2), (3, "2024-01-15", 3)}


def test_as_of_requests_of_one_long_lineage_make_no_product(spark):
    count = 100_000
    hour = lambda n: F.timestamp_seconds(n * 3600).cast("timestamp_ntz")
    versions = spark.range(count).select(
        "id", F.lit(7).alias("root_id"), hour(F.col("id")).alias("published_at"), F.lit(None).cast("date").alias("source_updated_date"))
    asked = spark.range(-5, count - 5).select(F.lit(7).alias("root_id"), (hour(F.col("id") + 3) - F.expr("INTERVAL 1 MINUTE")).alias("as_of"))
    got = L.as_of_versions(versions.repartition(8), asked.repartition(8))
    assert got.count() == count - 3 and got.where("timestampdiff(HOUR, timestamp_ntz'1970-01-01', as_of) <> id").isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "as_of" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_as_of_ties_and_awkward_requests(spark):
    import datetime as dt
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    pubs = spark.createDataFrame([(9, 1, t[0], None), (10, 1, t[0], None), (11, 1, t[2], None), (12, None, t[0], None), (13, 2, None, None)],
                                 "id int, root_id int, published_at timestamp_ntz, source_updated_date date")
    asked = spark.createDataFrame([(1, t[0]), (1, t[1]), (1, t[1]), (1, None), (None, t[2]), (2, t[2]), (3, t[2]), (1, t[2])],
                                  "root_id int, as_of timestamp_ntz")
    got = sorted((r.root_id, r.as_of, r.id) for r in L.as_of_versions(pubs, asked).collect())
    assert got == [(1, t[0], 9), (1, t[1], 9), (1, t[2], 11)]


def test_job_fold(spark):
    import datetime as dt
    t = [dt.datetime(2024, 1, 1, h) for h in range(6)]
    events = [(1, 1, "PENDING", t[0], None, None), (1, 2, "PROCESSING", t[1], "p1", None), (1, 3, "FAILED", t[2], None, "boom"),
              (2, 4, "PROCESSING", t[0], "p1", None), (2, 5, "FAILED", t[1], None, "x"), (2, 6, "PROCESSING", t[3], "p2", None),
              (3, 7, "PROCESSING", t[1], "p", None), (3, 8, "DONE", t[2], None, None)]
    log = spark.createDataFrame(events, "job_id int, event_id int, status string, ts timestamp_ntz, parser string, error string")
    got = {r.job_id: (r.status, r.parser, r.started_at, r.finished_at, r.error) for r in J.advance_job_state(log).collect()}
    assert got == {1: ("FAILED", "p1", t[1], t[2], "boom"), 2: ("PROCESSING", "p2", t[3], None, None),
                   3: ("PROCESSING", "p", t[1], None, None)}
    versioned = log.withColumns({"parser_version": F.when(F.col("event_id") == 2, "v2"), "artifact_id": F.col("job_id") * 10})
    got = {r.job_id: (r.parser_version, r.artifact_id) for r in J.advance_job_state(versioned).collect()}
    assert got == {1: ("v2", 10), 2: (None, 20), 3: (None, 30)}
    now = F.lit(t[5]).cast("timestamp_ntz")
    closed = J.stale_jobs(J.advance_job_state(log), now, stale_after_seconds=3 * 3600)
    assert {r.job_id for r in closed.where("stale").collect()} == {3}


def test_snapshots_ignore_unfinished_writes(spark, tmp_path):
    root = str(tmp_path / "state")
    assert snapshots.read_snapshot(spark, root) is None
    snapshots.write_snapshot(spark.range(3), root, 0)
    snapshots.write_snapshot(spark.range(5), root, 1)
    (tmp_path / "state" / "v=2").mkdir()
    assert snapshots.read_snapshot(spark, root).count() == 5
    assert snapshots.read_snapshot(spark, root, before=1).count() == 3


def test_block_content_as_its_schema_says(spark):
    texts = ['\ufeff{"a":1}', ' \t\n\r{"a":1}', "\x0b{}", "\xa0{}", None, "", "[1]", '"{"', '{"a":1,"a":2}', "{", "null", '{"a":NaN}', "{'a':1}",
             '{"a":"x"}', '{"a":"x"}\n', '{"a":"x\ny"}', '{"a":"\\q"}', '{"a":"x y"}', '{"":"x"}', '{"a":"x","b":"y"}', '{"a":"x"}}', "{ } ", "true",
             '{"a":"%s"}' % ("x" * 3000), '{"a":"\x7f"}', '{"a":01}', "\x00{}", '{"a":"tab\t"}']
    blocks = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "block_index int, content string").withColumns(
        {c: F.lit(None).cast("double") for c in ("bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1")})
    kind = F.coalesce(F.schema_of_variant(F.try_parse_json("content")).startswith("OBJECT"), F.lit(False))
    checked = I.check_block_rows(blocks)
    assert checked.where(F.array_contains("violations", "content") == kind).count() == 0
    # No schema is worked out, and nothing is interpreted row by row.
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "schema_of_variant" not in plan and "lambda" not in plan


def test_known_sources_are_looked_up_per_publication(spark):
    pubs = spark.createDataFrame([(1, "A", "x"), (2, "A", "y"), (3, None, "z")], "publication_id int, source string, source_document_id string")
    arts = spark.createDataFrame([(10, 1, "s1"), (11, 2, "s1"), (12, 3, "s2"), (13, 2, None), (14, 1, "s3")], "id int, publication_id int, sha256 string")
    sources = spark.createDataFrame([("A", "x", "pub/1"), (None, "z", "pub/3")], "source string, source_document_id string, object_path string")
    objects = spark.createDataFrame([("s1", "raw/s1"), (None, "raw/null")], "sha256 string, object_path string")
    shown = ["id", "skip_download", "skip_persist", "existing_object_path", "reason"]
    plain = I.dedup_decision(arts.join(pubs, "publication_id"), sources, objects).select(*shown)
    early = I.dedup_decision(arts.join(I.with_source_path(pubs, sources), "publication_id"), None, objects).select(*shown)
    rows = {tuple(r) for r in plain.collect()}
    assert rows == {tuple(r) for r in early.collect()} and len(rows) == 5
    assert (10, True, True, "pub/1", "source_document_id") in rows and (11, True, False, "raw/s1", "sha256") in rows


def test_dedup_query_deals_digests_once(spark):
    from __spark_entry__ import queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries()["dedup_decision"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Both sides of three joins, and the objects' digests: by digest once, not by digest and path.
    assert plan.count("Exchange hashpartitioning") == 6


def test_boxes_are_read_from_one_pass_over_the_cells(spark):
    from __spark_entry__ import queries

    for name in ("overlap_replaces_native", "merge_table_extractions"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan, name
