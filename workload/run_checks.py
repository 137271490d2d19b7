"""Whole runs: document processing, table payloads, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import cells as C
from quire.operators import ingest as I
from quire.operators import reconstruct as R
from quire.plans import ingest_run, process_run
from quire.session import new_shared_path, stored
from quire.sources.sidecars import parse_grid_sidecars
from quire.streaming import streams
from workload import views as v
from workload.ingest_checks import LATEST, now
from workload.page_checks import _CLASS_ARMS, _CLASSES, _HEADED, _TYPE, DECISION, headed_pages
from workload.registry import query
from workload.sql_views import fold
from workload.source_checks import sidecar_texts
from workload.table_checks import BLOCKS, BOXES, SHEET, TABLES, native_tables, rebuilt, sheet_table

_DEC = DECISION.replace(
    "FROM v_page)", "FROM (SELECT h.document_id, h.page_number, h.text, p.image_coverage, p.image_count, p.image_coverage_error FROM vh h JOIN v_page p USING (document_id, page_number)))"
)
RUN = TABLES + _DEC + f""", {_CLASSES},
  smp AS (SELECT document_id, substr(string_agg(text, chr(10) ORDER BY page_number), 1, 4000) AS t FROM vh WHERE page_number <= 5 AND trim(text, E' \\t\\n\\r') <> '' GROUP BY document_id),
  cf AS (SELECT h.document_id, {fold("concat_ws(chr(1), h.title, h.filename, s.t)")} AS f, {_TYPE.replace('document_type', 'h.document_type')} AS mc FROM v_head h LEFT JOIN smp s USING (document_id)),
  cp AS (SELECT document_id, mc, CASE {_CLASS_ARMS} END AS i FROM cf),
  cz AS (SELECT document_id, CASE WHEN i IS NOT NULL THEN document_class WHEN mc IS NOT NULL THEN mc ELSE 'other' END AS document_class, i IS NULL AND mc IS NULL AS unmatched FROM cp LEFT JOIN cr USING (i)),
  od AS (SELECT document_id, bool_or(needs_ocr) AS needs_ocr FROM decisions GROUP BY document_id),
  xr AS (SELECT document_id, bool_or(bad) AS bad FROM (SELECT document_id, status <> 'OK' AS bad FROM quality UNION ALL SELECT document_id, true FROM v_page p WHERE image_count > 0
      AND NOT EXISTS (SELECT 1 FROM v_table t WHERE t.document_id = p.document_id AND t.page = p.page_number)) GROUP BY document_id),
  ws AS (SELECT document_id, 1 AS rank, 0 AS page, 0 AS ti, 'ocr_required_but_engine_not_configured' AS w FROM od WHERE needs_ocr
    UNION ALL SELECT document_id, 2, 0, 0, 'classification_unmatched' FROM cz WHERE unmatched UNION ALL SELECT document_id, 4, 0, 0, 'table_extraction_needs_review' FROM xr WHERE bad
    UNION ALL SELECT document_id, 5, page, table_index, 'table_reconstruction_needs_review:' || table_id FROM rebuilt WHERE final_status = 'NEEDS_REVIEW'),
  wk AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY rank, page, ti, w) AS n FROM ws),
  we AS (SELECT document_id, string_agg(w, '; ' ORDER BY n) AS error FROM wk WHERE n <= 8 GROUP BY document_id)"""


_DEC_HEADED = (_HEADED + _DEC).replace("dec AS", "hdec AS").replace("dr AS", "hdr AS").replace("decisions AS", "hd AS").replace(
    "FROM dec)", "FROM hdec)").replace("FROM dr)", "FROM hdr)")


def requested(spark, d):
    return v.v_head(spark, d).select("document_id", "title", "filename", "document_type")


def processed(spark, d, ocr=False, sidecars=False):
    pages = headed_pages(spark, d)
    page_blocks = v.v_page(spark, d).select(
        "document_id", "page_number", F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    # Only the cells of the documents asked for are stored and assessed; the run would drop the others after that.
    cells = stored(v.v_cell(spark, d, v.v_head(spark, d).select("document_id")), "cells")
    native = native_tables(spark, d, cells).join(v.v_head(spark, d).select("document_id"), "document_id", "left_semi")
    tables = C.table_quality(cells, native)
    options = {}
    if ocr:
        page = F.col("document_id") + F.col("page_number")
        options["ocr_pages"] = pages.select("document_id", "page_number", F.lit("zq zq").alias("text"), F.lit("eye").alias("engine"), (
            F.when(page % 3 == 0, 0.4).otherwise(0.9)).alias("confidence"))
    if sidecars:
        found, grids, warnings = parse_grid_sidecars(stored(sidecar_texts(spark, d), "sidecars"))
        doc = F.col("document_id")
        documents = v.v_table(spark, d).select(doc).distinct().select(
            doc, F.concat(F.lit("art-"), doc).alias("artifact_id"), F.sha2(doc.cast("string"), 256).alias("source_sha256"),
            F.lit("label").alias("source_label"))
        options["raw_tables"], options["raw_cells"] = C.bind_sidecars(documents, found, grids)
        options["raw_warnings"] = warnings
    return process_run.process_pages(requested(spark, d), pages, page_blocks, tables, cells, **options)


@query(
    "process_pages",
    "v_cell v_table v_page v_head",
    RUN + """ SELECT document_id, document_class, coalesce(needs_ocr, false) AS needs_ocr, CASE WHEN error IS NULL THEN 'PROCESSED' ELSE 'NEEDS_REVIEW' END AS status, error
    FROM cz LEFT JOIN od USING (document_id) LEFT JOIN we USING (document_id)""",
)
def _(spark, d):
    return processed(spark, d).documents


@query(
    "process_pages_blocks",
    "v_page v_table",
    BLOCKS + """, keep AS (SELECT * FROM bl WHERE rank <> 1 AND document_id IN (SELECT doc_id FROM documents)),
    nb AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY rank, seq) - 1 AS block_index FROM keep)
    SELECT document_id, page_number, CASE rank WHEN 0 THEN 'native' ELSE 'table' END AS source, CAST(seq AS INTEGER) AS seq, block_index FROM nb
    WHERE (document_id, page_number) IN (SELECT document_id, page_number FROM v_page)""",
)
def _(spark, d):
    return processed(spark, d).blocks.select("document_id", "page_number", "source", "seq", "block_index")


@query(
    "process_blocks_content",
    "v_page v_table",
    BLOCKS + """, keep AS (SELECT * FROM (SELECT * FROM bl WHERE rank <> 1 UNION ALL SELECT document_id, page_number, 1, 0 FROM hd WHERE needs_ocr)
      WHERE document_id IN (SELECT doc_id FROM documents)),
    nb AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY rank, seq) - 1 AS block_index FROM keep)
    SELECT document_id, page_number, block_index, CASE rank WHEN 2 THEN 'table' ELSE 'text' END AS block_type, ['native', 'ocr', 'table_reconstruction'][rank + 1] AS source,
      CASE rank WHEN 0 THEN string_split(text, chr(10))[seq + 1] WHEN 1 THEN 'zq zq' END AS text, CASE rank WHEN 2 THEN table_id END AS table_id,
      CASE rank WHEN 1 THEN CASE WHEN (document_id + page_number) % 3 = 0 THEN 'low_confidence' ELSE 'sufficient_confidence' END END AS quality, true AS valid
    FROM nb JOIN (SELECT document_id, page_number, text FROM v_page) USING (document_id, page_number)
      LEFT JOIN (SELECT document_id, page AS page_number, table_index AS seq, table_id FROM v_table) t USING (document_id, page_number, seq)"""
    .replace(", keep AS", _DEC_HEADED + ", keep AS"),
)
def _(spark, d):
    blocks = I.check_block_rows(processed(spark, d, ocr=True).blocks.withColumns(
        {f"bbox_{c}": F.col("bbox")[c] for c in ("x0", "y0", "x1", "y1")}))
    at = lambda key: F.get_json_object("content", f"$.{key}")
    return blocks.select("document_id", "page_number", "block_index", "block_type", at("source").alias("source"), at("text").alias("text"),
                         at("table_id").alias("table_id"), at("quality_reason").alias("quality"), (F.size("violations") == 0).alias("valid"))


@query(
    "process_pages_ocr",
    "v_cell v_table v_page v_head",
    RUN.replace("SELECT document_id, 1 AS rank, 0 AS page, 0 AS ti, 'ocr_required_but_engine_not_configured' AS w FROM od WHERE needs_ocr",
                "SELECT DISTINCT document_id, 1 AS rank, 0 AS page, 0 AS ti, 'ocr_needs_review' AS w FROM decisions WHERE needs_ocr AND (document_id + page_number) % 3 = 0")
    + """ SELECT document_id, document_class, coalesce(needs_ocr, false) AS needs_ocr, CASE WHEN error IS NULL THEN 'PROCESSED' ELSE 'NEEDS_REVIEW' END AS status, error
    FROM cz LEFT JOIN od USING (document_id) LEFT JOIN we USING (document_id)""",
)
def _(spark, d):
    return processed(spark, d, ocr=True).documents


@query(
    "process_pages_sidecars",
    "v_cell v_table v_head",
    BOXES + """, sz AS (SELECT table_id, max("row") + 1 AS row_count, max("column") + 1 AS column_count FROM v_cell GROUP BY table_id),
    bad AS (SELECT string_agg(w, '; ' ORDER BY path) AS w FROM (SELECT 'raw_table_sidecar_failed:' || table_id || '.json:' || CASE WHEN document_id % 13 = 0 THEN 'JSONDecodeError' ELSE 'KeyError' END AS w,
      'dir/' || table_id || '.json' AS path FROM v_table WHERE document_id % 13 < 2 ORDER BY path COLLATE C LIMIT 8)),
    al AS (SELECT document_id, table_id, page, table_index, table_id AS t0 FROM v_table n
      WHERE CAST(right(table_id, 1) AS INTEGER) % 3 = 2 OR table_id NOT IN (SELECT table_id FROM boxes WHERE greatest(0, least(545, x1) - greatest(50, x0))
        * greatest(0, least(395, y1) - greatest(105, y0)) / least(495 * 290, (x1 - x0) * (y1 - y0)) >= 0.8) OR NOT EXISTS (SELECT 1 FROM v_table r
        WHERE r.document_id = n.document_id AND r.page = n.page AND r.table_index <> 1 AND r.document_id % 13 > 1 AND r.document_id % 3 <> 2)
      UNION ALL SELECT document_id, document_id || ':p' || page || ':raw:t' || table_index, page, table_index, table_id FROM v_table WHERE document_id % 13 > 1 AND document_id % 3 <> 2)
    SELECT document_id, al.table_id, page, table_index, row_count, column_count, contains((SELECT w FROM bad), 'sidecar') AS told
    FROM al JOIN sz ON sz.table_id = t0 WHERE document_id IN (SELECT document_id FROM v_head)""",
)
def _(spark, d):
    run = processed(spark, d, sidecars=True)
    told = run.documents.select("document_id", F.col("error").contains("raw_table_sidecar_failed").alias("told"))
    sizes = run.reconstruction.tables.select("document_id", "table_id", "page", "table_index", "row_count", "column_count")
    return sizes.join(told, "document_id")


@query(
    "process_workbook",
    "v_cell v_head",
    SHEET + """ SELECT document_id, sheet_index + 1 AS page_number, min(sheet_name) AS text, 1.0::DOUBLE AS width, 'table' AS block_type, 0 AS block_index, min(sheet_name) AS sheet_name,
      document_id || ':p' || (sheet_index + 1) || ':t0' AS table_id FROM sheet2 WHERE document_id IN (SELECT document_id FROM v_head) GROUP BY document_id, sheet_index""",
)
def _(spark, d):
    run = process_run.process_workbooks(requested(spark, d), sheet_table(spark, d))
    at = lambda key: F.get_json_object("content", f"$.{key}").alias(key)
    blocks = run.blocks.select("document_id", "page_number", "block_type", "block_index", at("sheet_name"), at("table_id"))
    return run.pages.select("document_id", "page_number", "text", "width").join(blocks, ["document_id", "page_number"])


@query(
    "process_unsupported",
    "v_head",
    """SELECT document_id, CASE document_id % 4 WHEN 1 THEN 'NEEDS_REVIEW' ELSE 'FAILED' END AS status, CASE document_id % 4 WHEN 1 THEN 'xls_not_supported_use_xlsx' ELSE 'unsupported_file_type' END AS warning,
      CASE document_id % 4 WHEN 1 THEN 'XLS is detected but only XLSX parsing is implemented' WHEN 2 THEN 'unsupported file type: unknown' ELSE 'unsupported file type: DOCX' END AS error
    FROM v_head WHERE document_id % 4 <> 0""",
)
def _(spark, d):
    kind = v.pick(F.col("document_id") % 4, ("PDF", "XLS", None, "DOCX"))
    return process_run.unsupported_documents(requested(spark, d).withColumn("file_type", kind)).drop("document_class", "needs_ocr")


@query(
    "table_intermediate_json",
    "v_cell v_table v_page",
    TABLES + """ SELECT table_id, 1 AS part, count(*) AS n_cells, CAST(sum(length(raw_text)) AS BIGINT) AS n_chars, coalesce(any_value(nr), 0) AS n_rows, coalesce(any_value(labels), '') AS labels, coalesce(any_value(kinds), '') AS kinds FROM v_cell
      LEFT JOIN (SELECT table_id, count(*) AS nr, string_agg(label, '~' ORDER BY r) AS labels, string_agg(kind, '~' ORDER BY r) AS kinds FROM body GROUP BY table_id) USING (table_id) GROUP BY table_id
    UNION ALL SELECT table_id, 0, NULL, NULL, column_count, table_type, final_status FROM rebuilt""".replace("final_status FROM rebuilt", "status FROM rebuilt"),
)
def _(spark, d):
    result, cells = rebuilt(spark, d)
    parts = R.table_intermediate_json(result, cells)
    body = (
        "struct<rows:array<struct<label:string,kind:string>>,cells:array<struct<raw_text:string>>,"
        "table_type:string,raw:struct<status:string,column_count:bigint>>"
    )
    p = F.col("p")
    read = parts.select("table_id", "part", F.explode(F.array(F.from_json("payload", body))).alias("p"))
    head = F.col("part") == 0
    texts = F.transform(p["cells"], lambda c: F.length(c["raw_text"]))
    return read.select(
        "table_id", "part",
        F.when(~head, F.size(p["cells"]).cast("bigint")).alias("n_cells"),
        F.when(~head, F.aggregate(texts, F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n_chars"),
        F.when(head, p["raw"]["column_count"]).otherwise(F.size(p["rows"]).cast("bigint")).alias("n_rows"),
        F.when(head, p["table_type"]).otherwise(F.array_join(F.transform(p["rows"], lambda r: r["label"]), "~")).alias("labels"),
        F.when(head, p["raw"]["status"]).otherwise(F.array_join(F.transform(p["rows"], lambda r: r["kind"]), "~")).alias("kinds"),
    )


# --- streams --------------------------------------------------------------------------------------


def file_stream(spark, d, name):
    schema = v.table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


@query(
    "stream_publications",
    "v_pub",
    LATEST + """ SELECT p.id, p.parent AS parent_publication_id, p.id IN (SELECT id FROM latest) AS is_latest_version,
      CASE WHEN p.needs_review THEN 'NEEDS_REVIEW' ELSE 'PENDING' END AS processing_status FROM linked p""",
)
def _(spark, d):
    feed, state = new_shared_path(spark, "feed"), new_shared_path(spark, "state")
    pubs = v.v_pub(spark, d)
    # Two files, the successors before many of their predecessors.
    pubs.repartitionByRange(2, F.desc("id")).write.parquet(feed)
    stream = spark.readStream.schema(pubs.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    streams.stream_publications(stream, state, new_shared_path(spark, "progress"), now()).awaitTermination()
    return streams.read_publications(spark, pubs.schema, state).select(
        "id", "parent_publication_id", "is_latest_version",
        ingest_run.shown_status().alias("processing_status"),
    )


@query(
    "stream_dedup",
    sql="""SELECT DISTINCT 'SRC' || (l_orderkey % 3) AS source, 'ord-' || l_orderkey AS source_document_id, 'att-' || l_linenumber AS attachment_reference FROM lineitem""",
)
def _(spark, d):
    key = F.col("l_orderkey")
    attachments = file_stream(spark, d, "lineitem").select(
        F.concat(F.lit("SRC"), key % 3).alias("source"), F.concat(F.lit("ord-"), key).alias("source_document_id"),
        F.concat(F.lit("att-"), "l_linenumber").alias("attachment_reference"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )
    deduped = streams.stream_dedup(attachments, delay="20 years").drop("created_at")
    return streams.run_to_files(deduped, new_shared_path(spark, "dedup"), new_shared_path(spark, "progress"))


@query(
    "stream_run_metrics",
    sql="""WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS s, event_type, (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS mark FROM events)
    SELECT s AS start, s + INTERVAL 1 HOUR AS "end", count(*) FILTER (event_type IN ('view', 'purchase')) AS downloaded, count(*) FILTER (event_type IN ('click', 'signup')) AS skipped,
      count(*) FILTER (event_type = 'error') AS failed FROM w WHERE s + INTERVAL 1 HOUR <= mark GROUP BY s""",
)
def _(spark, d):
    kind = F.col("event_type")
    outcome = F.when(kind.isin("view", "purchase"), "downloaded").when(kind == "error", "failed").otherwise("skipped")
    events = file_stream(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), outcome.alias("outcome"))
    counted = streams.stream_run_metrics(events)
    out = streams.run_to_files(counted, new_shared_path(spark, "metrics"), new_shared_path(spark, "progress"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(
    "stream_stale_jobs",
    "v_job",
    """, l AS (SELECT artifact_id, arg_max(status, ROW(ts, event_id)) AS status, max(ts) AS ts FROM v_job GROUP BY artifact_id)
    SELECT artifact_id AS job_id, 'FAILED' AS status, date_trunc('milliseconds', ts) + INTERVAL 3600 SECOND AS finished_at, 'stale_processing_recovered' AS error FROM l
    WHERE status = 'PROCESSING' AND epoch_ms(ts) + 3600000 < epoch_ms((SELECT max(ts) FROM v_job)) - 60000""",
)
def _(spark, d):
    status = F.create_map(*[F.lit(x) for pair in v.JOB_STATUS.items() for x in pair])
    jobs = file_stream(spark, d, "events").select(
        "event_id", F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.try_element_at(status, F.col("event_type")).alias("status"),
    )
    stale = streams.stream_stale_jobs(jobs)
    out = streams.run_to_files(stale, new_shared_path(spark, "stale"), new_shared_path(spark, "progress"))
    return out.withColumn("finished_at", F.col("finished_at").cast("timestamp_ntz"))
