"""Upserts, version chains, de-duplication, runs and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import ingest as I
from quire.operators import lineage as L
from quire.operators import upserts as U
from quire.plans import ingest_run, keyed_ingest
from quire.plans.keyed_state import KeyedState
from quire.session import new_shared_path, stored
from workload import views as v
from workload.registry import ORACLES, query

NOW = "TIMESTAMP '2030-01-01 00:00:00'"


def now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")


LINKED = """, linked AS (
  SELECT p.*, q.id AS parent, q.id IS NULL AND (p.supersedes IS NOT NULL OR p.is_correction) AS needs_review
  FROM v_pub p LEFT JOIN v_pub q ON q.source = p.source AND q.source_document_id = p.supersedes)"""
CLOSURE = LINKED + """, closure(id, root_id, depth) AS (
  SELECT id, id, CAST(0 AS BIGINT) FROM linked WHERE parent IS NULL
  UNION ALL SELECT l.id, c.root_id, c.depth + 1 FROM linked l JOIN closure c ON l.parent = c.id)"""
LATEST = CLOSURE + """, rooted AS (SELECT l.*, c.root_id, count(*) OVER (PARTITION BY c.root_id) AS size
    FROM linked l JOIN closure c USING (id)),
  leaf AS (SELECT id, size, needs_review, row_number() OVER (PARTITION BY root_id
      ORDER BY published_at DESC NULLS FIRST, CAST(id AS VARCHAR) DESC) AS n
    FROM rooted r WHERE NOT EXISTS (SELECT 1 FROM linked x WHERE x.parent = r.id)),
  latest AS (SELECT id FROM leaf WHERE n = 1 AND (size > 1 OR NOT needs_review))"""


def linked(spark, d):
    return L.link_predecessors(v.v_pub(spark, d))


@query(
    "latest_with_artifacts",
    "v_pub v_art",
    LATEST + """, art AS (SELECT publication_id, attachment_reference, min(ROW(created_at, id)) AS f FROM v_art GROUP BY ALL)
    SELECT p.id AS publication_id, p.company_id, p.source, p.source_document_id, c.root_id, p.published_at,
      a.attachment_reference, a.f[2] AS artifact_id
    FROM latest JOIN v_pub p USING (id) JOIN closure c USING (id) JOIN art a ON a.publication_id = p.id""",
)
def _(spark, d):
    pubs = v.v_pub(spark, d)
    state = U.publication_flags(pubs.where("id % 2 = 0"))
    return ingest_run.latest_with_artifacts(
        state, U.publication_flags(pubs).withColumn("seq", F.col("id")), v.v_art(spark, d), now()
    )


def _upsert_input(spark, d):
    pubs = U.publication_flags(v.v_pub(spark, d))
    state = pubs.where("id % 2 = 0").withColumn("title", F.lit("old"))
    batch = pubs.where("id % 3 < 2").withColumn("seq", F.col("id"))
    again = batch.where("id % 3 = 0").withColumns(
        {"title": F.concat("title", F.lit("!")), "seq": F.col("id") + 1000000000000,
         "company_id": F.lit(-1).cast("bigint")}
    )
    return state, batch.unionByName(again)


@query(
    "upsert_publications",
    "v_pub",
    f"""SELECT id, source, source_document_id, company_id,
      CASE WHEN id % 3 = 0 THEN title || '!' WHEN id % 3 = 1 THEN title ELSE 'old' END AS title,
      CASE WHEN id % 3 < 2 THEN {NOW} ELSE updated_at END AS updated_at, is_correction,
      supersedes IS NULL AND NOT (is_correction AND supersedes IS NULL) AS is_latest_version,
      CASE WHEN is_correction AND supersedes IS NULL THEN 'NEEDS_REVIEW' ELSE 'PENDING' END AS processing_status,
      id % 2 <> 0 AS created
    FROM v_pub WHERE id % 2 = 0 OR id % 3 < 2""",
)
def _(spark, d):
    state, batch = _upsert_input(spark, d)
    return U.upsert_publications(state, batch, now()).select(
        "id", "source", "source_document_id", "company_id", "title", "updated_at", "is_correction",
        "is_latest_version", "processing_status", "created",
    )


@query(
    "ensure_raw_objects",
    "v_art",
    """, s AS (SELECT sha256, min(ROW(created_at, id)) AS f FROM v_art WHERE file_size % 300 = 0 GROUP BY sha256),
    b AS (SELECT sha256, min(ROW(created_at, id)) AS f FROM v_art GROUP BY sha256)
    SELECT sha256, coalesce(s.f[2], b.f[2]) AS id, coalesce(s.f[1], b.f[1]) AS created_at FROM b LEFT JOIN s USING (sha256)""",
)
def _(spark, d):
    rows = v.v_art(spark, d).select("sha256", "id", "created_at", "file_size")
    state = U.first_per_key(rows.where("file_size % 300 = 0"), ["sha256"], ["created_at", "id"])
    return U.ensure_raw_objects(state, rows).drop("file_size")


@query(
    "ensure_artifacts",
    "v_art",
    """, s AS (SELECT publication_id, attachment_reference, min(ROW(created_at, id)) AS f FROM v_art WHERE publication_id % 2 = 0 AND file_size % 300 = 0 GROUP BY ALL),
    b AS (SELECT publication_id, attachment_reference, min(ROW(created_at, id)) AS f FROM v_art GROUP BY ALL)
    SELECT publication_id, attachment_reference, coalesce(s.f[2], b.f[2]) AS id FROM b LEFT JOIN s USING (publication_id, attachment_reference)""",
)
def _(spark, d):
    rows = v.v_art(spark, d)
    state = U.first_per_key(rows.where("publication_id % 2 = 0 AND file_size % 300 = 0"),
                            ["publication_id", "attachment_reference"], ["created_at", "id"])
    return U.ensure_artifacts(state, rows).select("publication_id", "attachment_reference", "id")


@query(
    "replace_document_output",
    "v_page",
    """SELECT document_id, page_number, CASE WHEN document_id % 3 = 0 THEN 'new ' || text ELSE text END AS text
    FROM v_page WHERE NOT (document_id % 3 = 0 AND page_number > 2)""",
)
def _(spark, d):
    pages = v.v_page(spark, d).select("document_id", "page_number", "text")
    batch = pages.where("document_id % 3 = 0 AND page_number <= 2")
    return U.replace_document_output(pages, batch.withColumn("text", F.concat(F.lit("new "), "text")))


def _kept_state(spark, name, rows, keys):
    state = KeyedState(spark, new_shared_path(spark, name), rows.schema, keys)
    state.write(rows, 0)
    return state


@query("upsert_publications_keyed", sql=ORACLES["upsert_publications"])
def _(spark, d):
    stored_rows, batch = _upsert_input(spark, d)
    state = _kept_state(spark, "keyed-publications", stored_rows.withColumn("created", F.lit(False)), U.PUBLICATION_KEY)
    keyed_ingest.upsert_publications_into(state, batch, now(), 1)
    return state.read().select(
        "id", "source", "source_document_id", "company_id", "title", "updated_at", "is_correction",
        "is_latest_version", "processing_status", "created",
    )


@query("ensure_raw_objects_keyed", sql=ORACLES["ensure_raw_objects"])
def _(spark, d):
    rows = v.v_art(spark, d).select("sha256", "id", "created_at", "file_size")
    known = U.first_per_key(rows.where("file_size % 300 = 0"), ["sha256"], ["created_at", "id"])
    state = _kept_state(spark, "keyed-objects", known, ["sha256"])
    keyed_ingest.insert_into(state, rows, ["created_at", "id"], 1)
    return state.read().drop("file_size")


@query("ensure_artifacts_keyed", sql=ORACLES["ensure_artifacts"])
def _(spark, d):
    rows, keys = v.v_art(spark, d), ["publication_id", "attachment_reference"]
    known = U.first_per_key(rows.where("publication_id % 2 = 0 AND file_size % 300 = 0"), keys, ["created_at", "id"])
    state = _kept_state(spark, "keyed-artifacts", known, keys)
    # In two batches, the second of which repeats half of the first.
    for version, part in enumerate(("publication_id % 3 < 2", "publication_id % 3 > 0"), 1):
        keyed_ingest.insert_into(state, rows.where(part), ["created_at", "id"], version)
    state.compact(least=2)
    return state.read().select("publication_id", "attachment_reference", "id")


@query("replace_document_output_keyed", sql=ORACLES["replace_document_output"])
def _(spark, d):
    pages = v.v_page(spark, d).select("document_id", "page_number", "text")
    state = _kept_state(spark, "keyed-pages", pages, ["document_id"])
    batch = pages.where("document_id % 3 = 0 AND page_number <= 2").withColumn("text", F.concat(F.lit("new "), "text"))
    for _ in range(2):  # a rerun changes nothing
        keyed_ingest.replace_in(state, batch, 1, processed=batch)
    return state.read()


@query("purge_by_document", "v_page", "SELECT document_id, page_number FROM v_page WHERE document_id % 4 <> 1")
def _(spark, d):
    pages = v.v_page(spark, d).select("document_id", "page_number")
    return U.purge_by_document(pages, pages.where("document_id % 4 = 1"))


@query(
    "seed_dimension",
    sql="""SELECT upper(c_name) AS ticker, CASE WHEN c_custkey % 3 = 0 THEN 'kept' ELSE c_mktsegment END AS company_name,
      c_custkey % 3 <> 0 AS created FROM customer""",
)
def _(spark, d):
    customer = v.table(spark, d, "customer")
    rows = customer.select(X.normalize_ticker(F.col("c_name")).alias("ticker"),
                           F.col("c_mktsegment").alias("company_name"), "c_custkey")
    state = rows.where("c_custkey % 3 = 0").select("ticker", F.lit("kept").alias("company_name"))
    return U.seed_dimension(state, rows.drop("c_custkey"))


@query(
    "mark_publications",
    "v_pub",
    """SELECT id, CASE WHEN id % 7 = 0 THEN false ELSE supersedes IS NULL AND NOT is_correction END AS is_latest_version,
      CASE WHEN id % 7 = 0 OR (is_correction AND supersedes IS NULL) THEN 'NEEDS_REVIEW' ELSE 'PENDING' END AS processing_status FROM v_pub""",
)
def _(spark, d):
    state = U.publication_flags(v.v_pub(spark, d)).select("id", "is_latest_version", "processing_status")
    return U.mark_publications(state, state.where("id % 7 = 0"), latest=False, status="NEEDS_REVIEW")


OUTCOMES = """, o AS (SELECT publication_id % 50 AS run_id, publication_id, id,
  CASE WHEN publication_id % 50 = 3 THEN 'failed' WHEN file_size % 700 = 0 AND publication_id % 50 <> 4 THEN 'failed'
    WHEN file_size % 500 = 0 THEN 'skipped' ELSE 'downloaded' END AS outcome FROM v_art)"""
METRICS = OUTCOMES + """, m AS (SELECT run_id, count(DISTINCT publication_id) AS discovered,
    count(*) FILTER (outcome = 'downloaded') AS downloaded, count(*) FILTER (outcome = 'skipped') AS skipped,
    count(*) FILTER (outcome = 'failed') AS failed FROM o GROUP BY run_id),
  metrics AS (SELECT *, CASE WHEN failed > 0 AND downloaded + skipped > 0 THEN 'PARTIAL' WHEN failed > 0 THEN 'FAILED'
    ELSE 'COMPLETED' END AS status FROM m)"""
SUMMARY = """, e AS (SELECT run_id, id, row_number() OVER (PARTITION BY run_id ORDER BY id) AS n FROM o WHERE outcome = 'failed'),
  summary AS (SELECT run_id, string_agg('failed ' || id, '; ' ORDER BY n) AS error_summary FROM e WHERE n <= 10 GROUP BY run_id)"""


def outcomes(spark, d):
    run, size = F.col("publication_id") % 50, F.col("file_size")
    failed = (run == 3) | (size % 700 == 0) & (run != 4)
    outcome = F.when(failed, "failed").when(size % 500 == 0, "skipped").otherwise("downloaded")
    return v.v_art(spark, d).select(
        run.alias("run_id"), "publication_id", outcome.alias("outcome"), F.col("id").alias("seq"),
        F.when(failed, F.concat(F.lit("failed "), "id")).alias("error"),
    )


@query("run_metrics", "v_art", METRICS + " SELECT * FROM metrics")
def _(spark, d):
    return I.run_metrics(outcomes(spark, d))


@query(
    "run_metrics_dry",
    "v_art",
    METRICS + """ SELECT run_id, discovered, CAST(0 AS BIGINT) AS downloaded, downloaded + skipped + failed AS skipped,
      CAST(0 AS BIGINT) AS failed, 'COMPLETED' AS status FROM metrics""",
)
def _(spark, d):
    return I.run_metrics(outcomes(spark, d), dry_run=True)


@query("error_summary", "v_art", METRICS + SUMMARY + " SELECT * FROM summary")
def _(spark, d):
    return I.error_summary(outcomes(spark, d))


@query(
    "start_finish_run",
    "v_art",
    METRICS + SUMMARY + f""", r AS (SELECT DISTINCT publication_id % 60 AS run_id FROM v_art)
    SELECT run_id, coalesce(status, 'RUNNING') AS status, discovered, downloaded, skipped, failed, error_summary,
      CASE WHEN status IS NOT NULL THEN {NOW} END AS finished_at
    FROM r LEFT JOIN metrics USING (run_id) LEFT JOIN summary USING (run_id)""",
)
def _(spark, d):
    rows = outcomes(spark, d)
    runs = v.v_art(spark, d).select((F.col("publication_id") % 60).alias("run_id")).distinct()
    return I.start_finish_run(runs, I.run_metrics(rows), rows, now()).select(
        "run_id", "status", "discovered", "downloaded", "skipped", "failed", "error_summary", "finished_at"
    )


@query(
    "discover",
    "v_pub",
    """SELECT id, source_document_id FROM v_pub WHERE source = 'SRC1'
      AND CAST(published_at AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1997-06-30'""",
)
def _(spark, d):
    pubs = v.v_pub(spark, d).withColumn("ticker", F.col("source")).withColumn(
        "published_at", F.concat(F.date_format("published_at", "yyyy-MM-dd"), F.lit("T23:30:00-11:00"))
    )
    return I.discover(pubs, "src1", "1995-03-01", "1997-06-30").select("id", "source_document_id")


@query(
    "discover_by_update_date",
    "v_pub",
    """SELECT id, source_updated_date, CAST(NULL AS TIMESTAMP) AS published_at, 'DATE' AS published_at_precision
    FROM v_pub WHERE source_updated_date >= DATE '1996-01-01'""",
)
def _(spark, d):
    return I.discover_by_update_date(v.v_pub(spark, d), "1996-01-01").select(
        "id", "source_updated_date", "published_at", "published_at_precision"
    )


@query(
    "lookup_by_key",
    "v_pub",
    "SELECT id, title FROM v_pub WHERE is_correction AND supersedes IS NOT NULL",
)
def _(spark, d):
    pubs = v.v_pub(spark, d)
    keys = pubs.where("is_correction AND supersedes IS NOT NULL").select("source", "source_document_id")
    return I.lookup_by_key(pubs, keys).select("id", "title")


@query("lookup_one", "v_pub", "SELECT id, title FROM v_pub WHERE source = 'SRC0' AND scope = 'parent'")
def _(spark, d):
    return I.lookup_one(v.v_pub(spark, d), source="SRC0", scope="parent").select("id", "title")


@query(
    "pdf_candidates",
    "v_art",
    "SELECT id FROM v_art WHERE (mime_type ILIKE '%pdf%' OR filename ILIKE '%.pdf') AND file_size > 1000",
)
def _(spark, d):
    return I.pdf_candidates(v.v_art(spark, d).withColumn("size_bytes", F.col("file_size"))).select("id")


@query(
    "pending_attachments",
    "v_art",
    """SELECT id FROM v_art a WHERE NOT EXISTS (SELECT 1 FROM v_art s WHERE s.file_size % 300 = 0
      AND s.publication_id = a.publication_id AND s.attachment_reference = a.attachment_reference)""",
)
def _(spark, d):
    art = v.v_art(spark, d)
    return I.pending_attachments(art, art.where("file_size % 300 = 0")).select("id")


@query(
    "dedup_decision",
    "v_art v_pub",
    """, b AS (SELECT a.id, a.sha256, p.source, p.source_document_id FROM v_art a JOIN v_pub p ON p.id = a.publication_id),
    o AS (SELECT DISTINCT sha256, 'raw/' || sha256 AS path FROM v_art WHERE file_size % 1000 = 0)
    SELECT b.id, p.id IS NOT NULL OR o.path IS NOT NULL AS skip_download, p.id IS NOT NULL AS skip_persist,
      coalesce('pub/' || p.id, o.path) AS existing_object_path,
      CASE WHEN p.id IS NOT NULL THEN 'source_document_id' WHEN o.path IS NOT NULL THEN 'sha256' END AS reason
    FROM b LEFT JOIN v_pub p ON p.id % 3 = 0 AND p.source = b.source AND p.source_document_id = b.source_document_id
      LEFT JOIN o USING (sha256)""",
)
def _(spark, d):
    pubs, art = v.v_pub(spark, d), v.v_art(spark, d)
    keys = pubs.select(F.col("id").alias("publication_id"), "source", "source_document_id")
    sources = pubs.where("id % 3 = 0").select(
        "source", "source_document_id", F.concat(F.lit("pub/"), F.col("id")).alias("object_path")
    )
    # Source keys are looked up per publication, before the artifacts meet it.
    keys = I.with_source_path(keys, sources).select("publication_id", "source_path")
    batch = art.select("id", "sha256", "publication_id").join(keys, "publication_id")
    objects = art.where("file_size % 1000 = 0").select("sha256").distinct().select(
        "sha256", F.concat(F.lit("raw/"), "sha256").alias("object_path")
    )
    return I.dedup_decision(batch, None, objects).select(
        "id", "skip_download", "skip_persist", "existing_object_path", "reason"
    )


@query(
    "candidate_key_distinct",
    "v_art",
    "SELECT DISTINCT 'SRC' || (publication_id % 3) || ':ord-' || publication_id || ':' || attachment_reference AS candidate_key FROM v_art",
)
def _(spark, d):
    key = F.col("publication_id")
    return I.candidate_key_distinct(v.v_art(spark, d).select(
        F.concat(F.lit("SRC"), key % 3).alias("source"),
        F.concat(F.lit("ord-"), key).alias("source_document_id"), "attachment_reference",
    ))


@query(
    "resolve_version",
    "v_pub",
    """, s AS (SELECT * FROM v_pub WHERE id % 2 = 0)
    SELECT b.id, CASE WHEN e.id IS NOT NULL THEN 'DUPLICATE' WHEN b.is_correction THEN 'CORRECTION'
        WHEN p.id IS NOT NULL THEN 'NEW_VERSION' ELSE 'NEW_DOCUMENT' END AS resolution,
      e.id AS existing_id, CASE WHEN e.id IS NULL THEN p.id END AS parent_id
    FROM v_pub b LEFT JOIN s e ON e.source = b.source AND e.source_document_id = b.source_document_id
      LEFT JOIN s p ON p.source = b.source AND p.source_document_id = b.supersedes""",
)
def _(spark, d):
    pubs = v.v_pub(spark, d)
    return L.resolve_version(pubs, pubs.where("id % 2 = 0")).select("id", "resolution", "existing_id", "parent_id")


@query(
    "link_predecessors",
    "v_pub",
    """, b AS (SELECT * FROM v_pub WHERE id % 4 <> 0)
    SELECT b.id, p.id AS parent_publication_id, p.id IS NULL AND (b.supersedes IS NOT NULL OR b.is_correction) AS needs_review
    FROM b LEFT JOIN v_pub p ON p.source = b.source AND p.source_document_id = b.supersedes""",
)
def _(spark, d):
    pubs = v.v_pub(spark, d)
    return L.link_predecessors(pubs.where("id % 4 <> 0"), pubs.where("id % 2 = 0")).select(
        "id", "parent_publication_id", "needs_review"
    )


@query("lineage_closure", "v_pub", CLOSURE + " SELECT * FROM closure")
def _(spark, d):
    return L.lineage_closure(linked(spark, d))


@query(
    "terminal_versions",
    "v_pub",
    LINKED + " SELECT id FROM linked p WHERE NOT EXISTS (SELECT 1 FROM linked c WHERE c.parent = p.id)",
)
def _(spark, d):
    return L.terminal_versions(linked(spark, d)).select("id")


@query("latest_leaf_flag", "v_pub", LATEST + " SELECT id, id IN (SELECT id FROM latest) AS is_latest_version FROM v_pub")
def _(spark, d):
    pubs = linked(spark, d)
    return L.latest_leaf_flag(pubs, L.lineage_closure(pubs)).select("id", "is_latest_version")


DAYS = ("1995-01-01", "1996-06-30", "1998-01-01", "1999-12-31", "2001-01-01")


@query(
    "as_of_versions",
    "v_pub",
    CLOSURE + f""", days AS (SELECT unnest({list(DAYS)!r}) AS as_of),
    k AS (SELECT d.as_of, c.root_id, p.id, row_number() OVER (PARTITION BY d.as_of, c.root_id
        ORDER BY coalesce(p.published_at, CAST(p.source_updated_date AS TIMESTAMP)) DESC, CAST(p.id AS VARCHAR) DESC) AS n
      FROM v_pub p JOIN closure c USING (id) JOIN days d
        ON coalesce(p.published_at, CAST(p.source_updated_date AS TIMESTAMP)) <= CAST(d.as_of AS TIMESTAMP))
    SELECT as_of, root_id, id FROM k WHERE n = 1""",
)
def _(spark, d):
    pubs = linked(spark, d)
    rooted = pubs.join(L.lineage_closure(pubs), "id")
    return L.as_of_versions(rooted, DAYS)


@query("extend_closure", "v_pub", CLOSURE + " SELECT * FROM closure")
def _(spark, d):
    # A third of the publications is labelled first; the others then come in one batch, with predecessors of labelled ones.
    pubs = v.v_pub(spark, d)
    before = L.link_predecessors(pubs.where("id % 3 = 0"))
    labels = stored(L.lineage_closure(before), "labels")
    after = linked(spark, d).select("id", "parent_publication_id")
    late = before.where("parent_publication_id IS NULL").select("id")
    batch = after.where("id % 3 <> 0").unionByName(
        after.where("parent_publication_id IS NOT NULL").join(late, "id", "left_semi"))
    found, moved = L.extend_closure(labels, batch)
    return L.moved_labels(labels, moved).unionByName(found.where("id % 3 <> 0"))


@query(
    "as_of_requests",
    "v_pub",
    CLOSURE + """, k AS (SELECT c.root_id, p.id, coalesce(p.published_at, CAST(p.source_updated_date AS TIMESTAMP)) AS known_at FROM v_pub p JOIN closure c USING (id)),
    t AS (SELECT root_id, known_at, arg_max(id, CAST(id AS VARCHAR)) AS id FROM k GROUP BY root_id, known_at),
    q AS (SELECT DISTINCT c.root_id, l_shipdate AS as_of FROM lineitem JOIN closure c ON c.id = l_orderkey)
    SELECT q.root_id, q.as_of, t.id FROM q ASOF JOIN t ON q.root_id = t.root_id AND CAST(q.as_of AS TIMESTAMP) >= t.known_at""",
)
def _(spark, d):
    pubs = stored(linked(spark, d), "linked")
    closure = stored(L.lineage_closure(pubs), "closure")
    lines = v.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("as_of"))
    return L.as_of_versions(pubs.join(closure, "id"), lines.join(closure, "id").select("root_id", "as_of"))


@query(
    "prefer_source_tier",
    "v_pub",
    """, s AS (SELECT *, source_reference AS r, strftime(updated_at, '%Y-%m') AS month FROM v_pub)
    SELECT id, title, month, CASE source WHEN 'SRC0' THEN 'A' WHEN 'SRC1' THEN 'B' ELSE 'C' END AS tier FROM s x
    WHERE NOT (source = 'SRC2' AND EXISTS (SELECT 1 FROM s y WHERE y.source = 'SRC0' AND y.title = x.title
      AND y.document_type = x.document_type AND y.month = x.month))""",
)
def _(spark, d):
    pubs = v.v_pub(spark, d).withColumn("month", F.date_format("updated_at", "yyyy-MM"))
    tiers = {"SRC0": "A", "SRC1": "B", "SRC2": "C"}
    return L.prefer_source_tier(pubs, ["title", "document_type", "month"], tiers).select(
        "id", "title", "month", "tier"
    )


@query(
    "company_artifacts",
    "v_art v_pub",
    """SELECT p.company_id, a.id, a.publication_id, a.created_at FROM v_art a JOIN v_pub p ON p.id = a.publication_id""",
)
def _(spark, d):
    return I.company_artifacts(v.v_art(spark, d), v.v_pub(spark, d)).select(
        "company_id", "id", "publication_id", "created_at"
    )


def raw_objects(spark, d):
    part = F.col("p_partkey").cast("string")
    return v.table(spark, d, "part").select(
        F.sha2(part, 256).alias("sha256"), (F.col("p_size") * 100).cast("bigint").alias("size_bytes"),
        X.raw_object_path(F.sha2(part, 256)).alias("object_path"), "p_partkey",
    )


RAW = """, raw AS (SELECT p_partkey, sha256(CAST(p_partkey AS VARCHAR)) AS sha256, CAST(p_size * 100 AS BIGINT) AS size_bytes,
  'raw_objects/' || substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 8) || '/' || sha256(CAST(p_partkey AS VARCHAR)) || '/blob' AS object_path FROM part)"""
CANDIDATES = RAW + """, j AS (SELECT a.*, r.size_bytes, r.object_path, p.title AS publication_title,
    row_number() OVER (PARTITION BY a.sha256 ORDER BY a.created_at DESC, a.id) AS n
  FROM v_art a JOIN raw r USING (sha256) JOIN v_pub p ON p.id = a.publication_id
  WHERE (a.mime_type ILIKE '%pdf%' OR a.filename ILIKE '%.pdf') AND r.size_bytes > 1000),
  c AS (SELECT * FROM j WHERE n = 1)"""


def candidates(spark, d):
    return I.artifact_export_candidates(
        v.v_art(spark, d), raw_objects(spark, d).drop("p_partkey"), v.v_pub(spark, d)
    )


@query("artifact_export_candidates", "v_art v_pub", CANDIDATES + " SELECT sha256, id, filename, object_path, size_bytes, publication_title FROM c")
def _(spark, d):
    return candidates(spark, d).select("sha256", "id", "filename", "object_path", "size_bytes", "publication_title")


@query(
    "pattern_priority_topk",
    "v_art v_pub",
    CANDIDATES + """ SELECT sha256, id, filename, CASE WHEN regexp_matches(filename, '(?i)file-1\\d*7') THEN 0 WHEN regexp_matches(filename, '(?i)9\\.PDF') THEN 1
      ELSE 2 END AS pattern_index FROM c WHERE regexp_matches(filename, '(?i)file-1\\d*7|9\\.PDF|0\\d*\\.pdf')
      ORDER BY pattern_index, sha256 LIMIT 120""",
)
def _(spark, d):
    return I.pattern_priority_topk(candidates(spark, d), (r"file-1\d*7", r"9\.PDF", r"0\d*\.pdf"), 120).select(
        "sha256", "id", "filename", "pattern_index"
    )


@query("newest_per_sha", "v_art", "SELECT sha256, id FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY created_at DESC, id) AS n FROM v_art) WHERE n = 1")
def _(spark, d):
    return I.newest_per_sha(v.v_art(spark, d)).select("sha256", "id")


@query("first_per_sha", "v_art", "SELECT sha256, min(id) AS id FROM v_art GROUP BY sha256")
def _(spark, d):
    return U.first_per_key(v.v_art(spark, d).select("sha256", "id"), ["sha256"], ["id"])


@query(
    "processing_requests",
    "v_art v_pub",
    RAW + """ SELECT a.id, r.object_path, p.title, p.document_type,
      CASE WHEN r.object_path IS NULL THEN 'raw object missing for artifact: ' || a.id END AS error
    FROM v_art a LEFT JOIN raw r ON r.sha256 = a.sha256 AND r.p_partkey % 10 <> 0
      LEFT JOIN v_pub p ON p.id = a.publication_id AND p.id % 6 <> 0""",
)
def _(spark, d):
    return I.processing_requests(
        v.v_art(spark, d), raw_objects(spark, d).where("p_partkey % 10 <> 0"),
        v.v_pub(spark, d).where("id % 6 <> 0"),
    ).select("id", "object_path", "title", "document_type", "error")


@query(
    "trace_provenance",
    "v_page v_pub",
    """SELECT b.document_id, b.page_number, p.id AS publication_id, p.source, p.source_document_id,
      sha256(CAST(p.company_id AS VARCHAR)) AS sha256, 'raw/' || p.company_id AS object_path
    FROM v_page b JOIN v_pub p ON p.id = b.document_id WHERE b.page_number % 3 <> 0 AND b.text <> ''""",
)
def _(spark, d):
    pages, pubs = v.v_page(spark, d), v.v_pub(spark, d)
    artifacts = pubs.select(
        "id", F.col("id").alias("publication_id"), F.sha2(F.col("company_id").cast("string"), 256).alias("sha256")
    )
    raw = v.table(spark, d, "customer").select(
        F.sha2(F.col("c_custkey").cast("string"), 256).alias("sha256"),
        F.concat(F.lit("raw/"), F.col("c_custkey")).alias("object_path"),
    )
    blocks = pages.where("text <> ''").select("document_id", "page_number")
    return I.trace_provenance(blocks, pages.where("page_number % 3 <> 0"), artifacts, raw, pubs)


@query(
    "drop_orphan_blocks",
    "v_page",
    "SELECT document_id, page_number FROM v_page WHERE page_number % 3 <> 0",
)
def _(spark, d):
    pages = v.v_page(spark, d).select("document_id", "page_number")
    return I.drop_orphan_blocks(pages, pages.where("page_number % 3 <> 0"))


@query("count_by_company", "v_pub", "SELECT company_id, count(*) AS documents FROM v_pub GROUP BY company_id")
def _(spark, d):
    return I.count_by_company(v.v_pub(spark, d))


TARGETS = {("en", "src1"): 30, ("de", "src6"): 10, ("fr", "src8"): 5, ("xx", "src0"): 1}


@query(
    "corpus_coverage",
    sql="""WITH t(kind, storage, target) AS (VALUES ('en', 'src1', 30::BIGINT), ('de', 'src6', 10), ('fr', 'src8', 5), ('xx', 'src0', 1)),
    c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL)
    SELECT kind, storage, target, coalesce(n, 0) AS items, coalesce(n, 0) >= target AS met
    FROM t LEFT JOIN c ON lang = kind AND source = storage""",
)
def _(spark, d):
    items = v.table(spark, d, "documents").select(F.col("lang").alias("kind"), F.col("source").alias("storage"))
    return I.corpus_coverage(items, TARGETS)


@query("company_documents_newest", "v_pub", "SELECT id, company_id, published_at FROM v_pub")
def _(spark, d):
    return I.company_documents_newest(v.v_pub(spark, d)).select("id", "company_id", "published_at")


def legacy(spark, d):
    pubs = v.v_pub(spark, d).select("id", "company_id", "source", "source_document_id", "title", "published_at")
    key = F.col("id")
    doubled = pubs.unionByName(pubs.where("id % 9 = 0").withColumn("id", key + 10000000))
    sha = F.sha2((key % 997).cast("string"), 256)
    return doubled.withColumns({
        "sha256": sha, "object_path": F.concat(F.lit("raw/"), key), "mime_type": F.lit("application/pdf"),
        "file_size": key % 1000, "filename": F.concat(F.lit("f"), key, F.lit(".pdf")),
    })


LEGACY = """, legacy AS (SELECT id, company_id, source, source_document_id, title, published_at FROM v_pub
    UNION ALL SELECT id + 10000000, company_id, source, source_document_id, title, published_at FROM v_pub WHERE id % 9 = 0),
  firsts AS (SELECT sha256(CAST(id % 997 AS VARCHAR)) AS sha256, id, row_number() OVER (PARTITION BY id % 997 ORDER BY CAST(id AS VARCHAR)) AS n FROM legacy)"""


@query("backfill_raw_objects", "v_pub", LEGACY + " SELECT sha256, id, 'raw/' || id AS object_path, id % 1000 AS size_bytes FROM firsts WHERE n = 1")
def _(spark, d):
    return I.backfill_raw_objects(legacy(spark, d)).select("sha256", "id", "object_path", "size_bytes")


@query(
    "backfill_publications",
    "v_pub",
    LEGACY + """ SELECT id, source, source_document_id, title FROM (SELECT *, row_number() OVER (PARTITION BY source, source_document_id
      ORDER BY CAST(id AS VARCHAR)) AS n FROM legacy) WHERE n = 1 AND (CASE WHEN id > 10000000 THEN id - 10000000 ELSE id END) % 8 <> 0""",
)
def _(spark, d):
    return I.backfill_publications(legacy(spark, d), v.v_pub(spark, d).where("id % 8 = 0")).select(
        "id", "source", "source_document_id", "title"
    )


@query(
    "backfill_artifacts",
    "v_pub",
    LEGACY + """ SELECT l.id, l.id AS publication_id, 'raw/' || l.id AS attachment_reference, f.id AS raw_object_id
      FROM legacy l JOIN firsts f ON f.n = 1 AND f.sha256 = sha256(CAST(l.id % 997 AS VARCHAR))""",
)
def _(spark, d):
    rows = legacy(spark, d)
    return I.backfill_artifacts(rows, I.backfill_raw_objects(rows)).select(
        "id", "publication_id", "attachment_reference", "raw_object_id"
    )


@query(
    "check_page_rows",
    "v_page",
    """SELECT document_id, page_number, concat_ws(',', CASE WHEN document_id % 7 = 0 THEN 'size' END,
      CASE WHEN document_id % 2 = 0 AND document_id % 5 = 0 THEN 'native_confidence' END,
      CASE WHEN document_id % 2 = 1 AND document_id % 5 <> 0 THEN 'ocr_confidence' END) AS violations FROM v_page""",
)
def _(spark, d):
    doc = F.col("document_id")
    pages = v.v_page(spark, d).withColumns({
        "width": F.when(doc % 7 == 0, 0.0).otherwise(F.col("width")),
        "extraction_method": F.when(doc % 2 == 0, "native").otherwise("ocr"),
        "ocr_confidence": F.when(doc % 5 == 0, 0.5),
    })
    return I.check_page_rows(pages).select(
        "document_id", "page_number", F.array_join("violations", ",").alias("violations")
    )


@query(
    "check_block_rows",
    "v_cell",
    """SELECT table_id, "row", "column", concat_ws(',', CASE WHEN "row" = 1 AND has_box AND "column" <> 2 THEN 'bbox_order' END,
      CASE WHEN "column" = 2 AND has_box THEN 'bbox_partial' END,
      CASE WHEN "row" = 0 THEN 'block_index' END,
      CASE WHEN raw_text = '' THEN 'content' END) AS violations FROM v_cell""",
)
def _(spark, d):
    blocks = v.v_cell(spark, d).select(
        "table_id", "row", "column", (F.col("row") - 1).alias("block_index"),
        F.when(F.col("raw_text") != "", F.to_json(F.struct("raw_text"))).alias("content"),
        F.when(F.col("column") != 2, F.col("bbox.x0")).alias("bbox_x0"), F.col("bbox.y0").alias("bbox_y0"),
        (F.col("bbox.x1") - F.when(F.col("row") == 1, 200).otherwise(0)).alias("bbox_x1"),
        F.col("bbox.y1").alias("bbox_y1"),
    )
    return I.check_block_rows(blocks).select(
        "table_id", "row", "column", F.array_join("violations", ",").alias("violations")
    )


@query(
    "check_companies",
    sql="""SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN upper(c_mktsegment) END AS ticker,
      concat_ws(',', CASE WHEN c_custkey % 10 = 0 THEN 'ticker' END,
        CASE WHEN c_nationkey NOT BETWEEN 1 AND 12 THEN 'fiscal_year_end_month' END) AS violations FROM customer""",
)
def _(spark, d):
    companies = v.table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("fiscal_year_end_month"),
        F.when(F.col("c_custkey") % 10 == 0, " \t").otherwise(F.lower("c_mktsegment")).alias("ticker"),
    )
    return I.check_companies(companies).select(
        "c_custkey", "ticker", F.array_join("violations", ",").alias("violations")
    )


@query(
    "check_enums",
    "v_job",
    """SELECT event_id, concat_ws(',', CASE WHEN event_id % 7 = 0 THEN 'status' END,
      CASE WHEN event_id % 5 = 0 THEN 'method' END, CASE WHEN NOT value BETWEEN 0 AND 1 THEN 'value' END) AS violations FROM v_job""",
)
def _(spark, d):
    key = F.col("event_id")
    jobs = v.v_job(spark, d).select(
        key, "value", F.when(key % 7 == 0, "DONE").otherwise(F.col("status")).alias("status"),
        F.when(key % 5 == 0, "OCR").when(key % 5 == 1, "ocr").alias("method"),
    )
    checked = I.check_enums(jobs, {"status": "processing_status", "method": "extraction_method"}, ["value"])
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))
