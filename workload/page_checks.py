"""Pages, headings, classes, OCR decisions and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import values as V
from quire.operators import jobs as J
from quire.operators import pages as P
from quire.operators import sections as S
from workload import views as v
from workload.registry import query
from workload.sql_views import fold

_ORDERED = sorted(V.HEADING_RULES, key=lambda r: -r.priority)
RULES = "rules(matched_rule, section, confidence, priority) AS (VALUES " + ", ".join(
    f"('{r.name}', '{r.section}', {r.confidence}::DOUBLE, {r.priority})" for r in _ORDERED
) + ")"


def heading_sql(line: str) -> str:
    arms = " ".join(f"WHEN regexp_matches(f, '{r.pattern}') THEN '{r.name}'" for r in _ORDERED)
    return f"(CASE WHEN length(trim({line})) BETWEEN 1 AND 180 THEN (SELECT CASE {arms} END FROM (SELECT {fold(f'trim({line})')} AS f)) END)"


LINES = """, ln0 AS (SELECT document_id, page_number, string_split(text, chr(10)) AS ls, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM v_head),
  ln AS (SELECT document_id, page_number, CAST(i AS INTEGER) AS line_no, ls[i + 1] AS line,
    CAST(coalesce(sum(length(ls[i + 1]) + 1) OVER (PARTITION BY document_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char
    FROM ln0 WHERE NOT (i = len(ls) - 1 AND ls[i + 1] = ''))"""
_FOLDED_LINE = fold("trim(line, E' \\t\\n\\r')")
_ARMS = " ".join(f"WHEN regexp_matches(f, '{r.pattern}') THEN '{r.name}'" for r in _ORDERED)
HITS = LINES + f""", {RULES}, lf AS (SELECT *, CASE WHEN length(trim(line)) BETWEEN 1 AND 180 THEN {_FOLDED_LINE} END AS f FROM ln),
  lr AS (SELECT *, CASE WHEN f IS NULL THEN NULL {_ARMS} END AS matched_rule FROM lf),
  heads AS (SELECT document_id, page_number, line_no, line, start_char, matched_rule, section, confidence, priority
    FROM lr JOIN rules USING (matched_rule)),
  hits AS (SELECT document_id, page_number, section, matched_rule, trim(line) AS matched_text, confidence, start_char
    FROM (SELECT *, row_number() OVER (PARTITION BY document_id, page_number, section ORDER BY line_no) AS n FROM heads) WHERE n = 1)"""


@query("split_lines", "v_head", LINES + " SELECT document_id, page_number, line_no, start_char, line FROM ln")
def _(spark, d):
    return S.split_lines(v.v_head(spark, d))


@query("match_headings", "v_head", HITS + " SELECT document_id, page_number, line_no, start_char, line, section, matched_rule, confidence, priority FROM heads")
def _(spark, d):
    return S.match_headings(S.split_lines(v.v_head(spark, d)))


@query("collect_section_hits", "v_head", HITS + " SELECT * FROM hits")
def _(spark, d):
    return S.collect_section_hits(v.v_head(spark, d))


@query(
    "collect_all_section_hits",
    "v_head",
    HITS + " SELECT document_id, page_number, section, matched_rule, trim(line) AS matched_text, confidence, start_char FROM heads",
)
def _(spark, d):
    return S.collect_section_hits(v.v_head(spark, d), one_hit_per_section=False)


@query("first_hit_per_section", "v_head", HITS + " SELECT document_id, page_number, section, matched_rule, confidence, start_char FROM hits")
def _(spark, d):
    heads = S.match_headings(S.split_lines(v.v_head(spark, d)))
    return S.first_hit_per_section(
        heads.select("document_id", "page_number", "section", "start_char", "matched_rule", "confidence")
    )


@query("running_offset", "v_head", LINES + " SELECT document_id, count(*) AS lines, max(start_char) AS last_start FROM ln GROUP BY document_id")
def _(spark, d):
    return S.split_lines(v.v_head(spark, d)).groupBy("document_id").agg(
        F.count(F.lit(1)).alias("lines"), F.max("start_char").alias("last_start")
    )


@query(
    "best_heading",
    "v_head",
    HITS + f""", best AS (SELECT document_id, section, trim(line) AS matched_text, confidence FROM (SELECT *, row_number() OVER (PARTITION BY document_id
        ORDER BY priority DESC, line_no) AS n FROM heads) WHERE n = 1),
      whole AS (SELECT document_id, substr(trim(text, E' \\t\\n\\r'), 1, 180) AS t FROM v_head),
      wf AS (SELECT document_id, t, {fold("trim(t, E' \\t\\n\\r')")} AS f FROM whole),
      wr AS (SELECT document_id, t, CASE {_ARMS} END AS matched_rule FROM wf)
    SELECT h.document_id, coalesce(b.section, r.section) AS section, coalesce(b.matched_text, CASE WHEN r.section IS NOT NULL THEN w.t END) AS matched_text,
      coalesce(b.confidence, r.confidence) AS confidence
    FROM v_head h LEFT JOIN best b USING (document_id) LEFT JOIN wr w USING (document_id) LEFT JOIN rules r ON r.matched_rule = w.matched_rule""",
)
def _(spark, d):
    return v.v_head(spark, d).select("document_id", S.best_heading(F.col("text")).alias("b")).select(
        "document_id", "b.section", "b.matched_text", "b.confidence"
    )


SHEET_NAMES = ("Balance sheet", "Sheet1", "Thuyết minh", "Cash flow statement", "KQKD", "balance-sheet (2)",
               "Báo cáo kết quả hoạt động kinh doanh")


def sheets(spark, d):
    doc = F.col("document_id")
    return v.v_page(spark, d).select(
        doc, (F.col("page_number") - 1).alias("sheet_index"),
        v.pick((doc + F.col("page_number") * 3) % 7, SHEET_NAMES).alias("sheet_name"), "text",
    )


_SHEETS = ", sh AS (SELECT document_id, page_number - 1 AS sheet_index, CASE (document_id + page_number * 3) % 7 " + " ".join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate(SHEET_NAMES)) + " END AS sheet_name, text FROM v_page)"


@query(
    "sheet_section_hits",
    "v_page",
    _SHEETS + f""", {RULES}, f AS (SELECT *, {fold('sheet_name')} AS f FROM sh), r AS (SELECT *, CASE {_ARMS} END AS matched_rule FROM f),
    k AS (SELECT *, row_number() OVER (PARTITION BY document_id, section ORDER BY sheet_index) AS n FROM r JOIN rules USING (matched_rule))
    SELECT document_id, section, matched_rule, sheet_name AS matched_text, confidence, sheet_index + 1 AS page_number FROM k WHERE n = 1""",
)
def _(spark, d):
    return S.sheet_section_hits(sheets(spark, d))


# Several pages per document: pages of v_page with a heading in front of some.
def page_hits(spark, d):
    return S.collect_section_hits(headed_pages(spark, d))


def headed_pages(spark, d):
    n = (F.col("document_id") + F.col("page_number")) % 8
    return v.v_page(spark, d).withColumn("text", F.concat(v.pick(n, v.HEADINGS), F.col("text")))


_HEADED = ", vh AS (SELECT document_id, page_number, CASE (document_id + page_number) % 8 " + " ".join(
    "WHEN {} THEN '{}'".format(i, h.replace("\n", "' || chr(10) || '")) for i, h in enumerate(v.HEADINGS)) + " END || text AS text FROM v_page)"
PAGE_HITS = _HEADED + HITS.replace("FROM v_head", "FROM vh").replace(
    "PARTITION BY document_id ORDER BY i", "PARTITION BY document_id, page_number ORDER BY i")


@query(
    "sections_found",
    "v_page",
    PAGE_HITS + """, s AS (SELECT document_id, section, min(ROW(page_number, start_char)) AS a FROM hits GROUP BY ALL)
    SELECT document_id, string_agg(section, '|' ORDER BY a, section) AS sections_found,
      string_agg(CAST(a[1] AS VARCHAR), '|' ORDER BY a, section) AS first_pages FROM s GROUP BY document_id""",
)
def _(spark, d):
    return S.sections_found(page_hits(spark, d)).select(
        "document_id", F.array_join("sections_found", "|").alias("sections_found"),
        F.array_join(F.col("first_pages").cast("array<string>"), "|").alias("first_pages"),
    )


@query(
    "merge_section_hits",
    "v_page",
    PAGE_HITS + """, a AS (SELECT * FROM hits WHERE document_id % 2 = 0), b AS (SELECT * FROM hits WHERE document_id % 3 = 0 OR page_number % 2 = 0)
    SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.document_id = b.document_id AND a.page_number = b.page_number
      AND a.section = b.section AND a.matched_text = b.matched_text)""",
)
def _(spark, d):
    hits = page_hits(spark, d)
    return S.merge_section_hits(hits.where("document_id % 2 = 0"), hits.where("document_id % 3 = 0 OR page_number % 2 = 0"))


@query(
    "section_hint_join",
    "v_page v_table",
    PAGE_HITS + """, h AS (SELECT document_id, page_number AS page, min(section) AS section_hint FROM hits GROUP BY ALL HAVING count(DISTINCT section) = 1)
    SELECT table_id, document_id, page, table_index, section_hint FROM v_table LEFT JOIN h USING (document_id, page)""",
)
def _(spark, d):
    return S.section_hint_join(v.v_table(spark, d), page_hits(spark, d))


_CLASS_ARMS = " ".join(f"WHEN regexp_matches(f, '{r.pattern}') THEN {i}" for i, r in enumerate(V.CLASS_RULES))
_CLASSES = "cr(i, document_class, confidence, name) AS (VALUES " + ", ".join(
    f"({i}, '{r.document_class}', {r.confidence}::DOUBLE, '{r.name}')" for i, r in enumerate(V.CLASS_RULES)) + ")"
_FIELDS = fold("concat_ws(chr(1), title, filename, substr(text, 1, 4000))")
_TYPE = """CASE lower(trim(document_type)) WHEN 'periodic_report' THEN 'annual_report' WHEN 'event_disclosure' THEN 'material_disclosure'
  WHEN 'other' THEN 'other' WHEN 'financial_statement' THEN 'financial_statement' WHEN 'material_disclosure' THEN 'material_disclosure' END"""


def classify_sql(accept: float) -> str:
    return f""", {_CLASSES}, f AS (SELECT document_id, document_type, {_FIELDS} AS f FROM v_head),
    p AS (SELECT *, CASE {_CLASS_ARMS} END AS i, {_TYPE} AS mc FROM f)
    SELECT document_id, CASE WHEN confidence >= {accept} THEN document_class WHEN mc IS NOT NULL AND 0.75 >= {accept} THEN mc
        WHEN i IS NOT NULL THEN document_class ELSE 'other' END AS document_class,
      CASE WHEN (confidence >= {accept}) IS NOT TRUE AND mc IS NOT NULL AND 0.75 >= {accept} THEN 'metadata' ELSE 'pattern' END AS method,
      CASE WHEN confidence >= {accept} THEN confidence WHEN mc IS NOT NULL AND 0.75 >= {accept} THEN 0.75::DOUBLE
        WHEN i IS NOT NULL THEN confidence ELSE 0::DOUBLE END AS confidence,
      CASE WHEN (confidence >= {accept}) IS NOT TRUE AND mc IS NOT NULL AND 0.75 >= {accept} THEN NULL ELSE name END AS matched_pattern,
      CASE WHEN confidence >= {accept} THEN 'pattern_match' WHEN mc IS NOT NULL AND 0.75 >= {accept} THEN 'metadata:document_type'
        WHEN i IS NOT NULL THEN 'pattern_below_threshold' ELSE 'unmatched_needs_llm' END AS reason
    FROM p LEFT JOIN cr USING (i)"""


def classifier_input(spark, d):
    return v.v_head(spark, d).select(
        "document_id", "title", "filename", F.substring("text", 1, 4000).alias("text_sample"),
        F.create_map(F.lit("document_type"), F.col("document_type")).alias("metadata"),
    )


@query("classify_documents", "v_head", classify_sql(0.60))
def _(spark, d):
    return S.classify_documents(classifier_input(spark, d))


@query("classify_documents_strict", "v_head", classify_sql(0.90))
def _(spark, d):
    return S.classify_documents(classifier_input(spark, d), accept_confidence=0.90)


@query(
    "rule_join",
    "v_head",
    f""", {_CLASSES}, f AS (SELECT document_id, {fold('text')} AS f FROM v_head), p AS (SELECT document_id, CASE {_CLASS_ARMS} END AS i FROM f)
    SELECT document_id, name AS matched_pattern, document_class FROM p LEFT JOIN cr USING (i)""",
)
def _(spark, d):
    found = v.v_head(spark, d).select("document_id", S.class_rule(F.col("text")).alias("r"))
    return found.select("document_id", "r.matched_pattern", "r.document_class")


@query(
    "classify_by_metadata",
    "v_pub",
    """SELECT id, coalesce(CASE WHEN id % 6 = 0 THEN 'annual_report' END, CASE WHEN id % 9 = 0 THEN 'board_resolution' END,
        CASE document_type WHEN 'periodic_report' THEN 'annual_report' WHEN 'event_disclosure' THEN 'material_disclosure' ELSE document_type END) AS document_class,
      CASE WHEN id % 6 = 0 OR id % 9 = 0 THEN 0.80::DOUBLE ELSE 0.75::DOUBLE END AS confidence,
      CASE WHEN id % 6 = 0 THEN 'metadata:document_class' WHEN id % 9 = 0 THEN 'metadata:doc_class' ELSE 'metadata:type' END AS reason FROM v_pub""",
)
def _(spark, d):
    key = F.col("id")
    metadata = F.create_map(
        F.lit("document_class"), F.when(key % 6 == 0, " ANNUAL_report").otherwise("nothing"),
        F.lit("doc_class"), F.when(key % 9 == 0, "board_resolution"), F.lit("type"), "document_type",
    )
    return S.classify_by_metadata(v.v_pub(spark, d).select("id", metadata.alias("metadata")))


# --- OCR and page text ----------------------------------------------------------------------------

DECISION = """, dec AS (SELECT document_id, page_number, text, image_coverage, image_count, image_coverage_error, CAST(length(trim(text, E' \\t\\n\\r')) AS INTEGER) AS char_count FROM v_page),
  dr AS (SELECT *, CASE WHEN char_count >= 50 THEN 'sufficient_native_text' WHEN image_coverage IS NULL THEN 'image_coverage_unavailable'
    WHEN image_coverage_error IS NOT NULL THEN 'image_coverage_incomplete' WHEN char_count = 0 AND image_coverage < 0.05 THEN 'blank_page'
    WHEN image_coverage >= 0.20 THEN 'low_text_high_image_coverage' WHEN char_count = 0 THEN 'image_only_page' ELSE 'insufficient_native_text' END AS reason FROM dec),
  decisions AS (SELECT *, reason NOT IN ('sufficient_native_text', 'blank_page') AS needs_ocr FROM dr)"""


@query(
    "page_ocr_decision",
    "v_page",
    DECISION + """ SELECT document_id, page_number, char_count, image_coverage, image_count, image_coverage_error, reason, needs_ocr,
      'ocr-policy-v1' AS policy_version, 50 AS policy_min_native_chars, 0.20::DOUBLE AS policy_high_image_coverage, 0.05::DOUBLE AS policy_low_image_coverage FROM decisions""",
)
def _(spark, d):
    return P.page_ocr_decision(v.v_page(spark, d))


@query(
    "document_ocr_decision",
    "v_page",
    DECISION + """, a AS (SELECT document_id, bool_or(needs_ocr) AS n FROM decisions WHERE document_id % 9 <> 0 GROUP BY document_id)
    SELECT doc_id AS document_id, coalesce(n, false) AS needs_ocr, CASE WHEN n IS NULL THEN 'empty_document' WHEN n THEN 'pages_require_ocr'
      ELSE 'all_pages_native_or_blank' END AS reason FROM documents LEFT JOIN a ON doc_id = document_id""",
)
def _(spark, d):
    decisions = P.page_ocr_decision(v.v_page(spark, d).where("document_id % 9 <> 0"))
    documents = v.table(spark, d, "documents").select(F.col("doc_id").alias("document_id"))
    return P.document_ocr_decision(documents, decisions)


@query(
    "image_coverage",
    "v_cell",
    """, img AS (SELECT document_id, page AS page_number, table_index * 1000 + "row" * 10 + "column" AS seq,
      CASE WHEN "column" = 1 AND "row" % 2 = 1 THEN 'RuntimeError' WHEN NOT has_box THEN 'no_rects' END AS bad, 2000.0::DOUBLE AS area
      FROM v_cell WHERE page < 4 AND document_id % 7 <> 0),
    agg AS (SELECT document_id, page_number, count(*) AS n, count(*) FILTER (bad IS NULL) AS good, sum(area) FILTER (bad IS NULL) AS covered,
      string_agg('xref=' || seq || ':' || bad, '; ' ORDER BY seq) AS problems FROM img GROUP BY ALL),
    pg AS (SELECT DISTINCT document_id, page AS page_number, CASE WHEN document_id % 10 = 0 THEN 0 ELSE 842 END::DOUBLE AS height FROM v_cell)
    SELECT document_id, page_number, CASE WHEN n IS NULL THEN 0::DOUBLE WHEN height > 0 AND good > 0 THEN least(covered / (595.0::DOUBLE * height), 1) END AS image_coverage,
      coalesce(n, 0) AS image_count, CASE WHEN n IS NULL THEN NULL WHEN height = 0 THEN 'page_area_non_positive'
        WHEN good = 0 THEN coalesce(problems, 'image_geometry_unavailable') ELSE problems END AS image_coverage_error
    FROM pg LEFT JOIN agg USING (document_id, page_number)""",
)
def _(spark, d):
    cells = v.v_cell(spark, d)
    seq = F.col("table_index") * 1000 + F.col("row") * 10 + F.col("column")
    box = F.col("bbox")
    images = cells.where("page < 4 AND document_id % 7 <> 0").select(
        "document_id", F.col("page").alias("page_number"), seq.alias("seq"), seq.alias("xref"),
        ((box["x1"] - box["x0"]) * (box["y1"] - box["y0"])).alias("area"),
        F.when((F.col("column") == 1) & (F.col("row") % 2 == 1), "RuntimeError").alias("error"),
    )
    pages = cells.select("document_id", F.col("page").alias("page_number")).distinct().select(
        "*", F.lit(595.0).alias("width"),
        F.when(F.col("document_id") % 10 == 0, 0.0).otherwise(842.0).alias("height"),
    )
    return P.image_coverage(pages, images)


QUALITY = """, q AS (SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS text,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'nan'::DOUBLE WHEN event_id % 3 = 0 THEN value ELSE value / 100 END AS confidence FROM events),
  qr AS (SELECT *, CASE WHEN trim(text) = '' THEN 'no_text_detected' WHEN confidence IS NULL THEN 'missing_confidence'
    WHEN isnan(confidence) OR confidence < 0 OR confidence > 1 THEN 'invalid_confidence' WHEN confidence < 0.60 THEN 'low_confidence' ELSE 'sufficient_confidence' END AS quality_reason FROM q)"""


def ocr_pages(spark, d):
    key, value = F.col("event_id"), F.col("value")
    confidence = (
        F.when(key % 7 == 0, None).when(key % 5 == 0, float("nan")).when(key % 3 == 0, value)
        .otherwise(value / 100)
    )
    return v.table(spark, d, "events").select(
        key, F.col("user_id").alias("document_id"),
        F.when(key % 11 == 0, " ").otherwise(F.col("event_type")).alias("text"),
        confidence.alias("confidence"),
    )


@query(
    "ocr_quality",
    sql="WITH " + QUALITY[2:] + """ SELECT event_id, text, quality_reason, CASE WHEN quality_reason = 'sufficient_confidence' THEN 'OK' ELSE 'NEEDS_REVIEW' END AS status,
      'ocr-quality-v1' AS quality_policy_version, 0.60::DOUBLE AS quality_policy_min_confidence FROM qr""",
)
def _(spark, d):
    return P.ocr_quality(ocr_pages(spark, d)).drop("document_id", "confidence")


@query(
    "ocr_needs_review",
    sql="WITH " + QUALITY[2:] + " SELECT user_id AS document_id, bool_or(quality_reason <> 'sufficient_confidence') AS needs_review FROM qr GROUP BY user_id",
)
def _(spark, d):
    return P.ocr_needs_review(P.ocr_quality(ocr_pages(spark, d)))


@query(
    "ocr_page_text",
    "v_head",
    LINES + """ SELECT document_id, page_number, avg(CASE WHEN line_no % 5 <> 0 THEN (line_no % 8) / 8.0::DOUBLE END) AS confidence,
      coalesce(trim(string_agg(line, chr(10) ORDER BY line_no) FILTER (line <> ''), E' \\t\\n\\r'), '') AS text FROM ln GROUP BY document_id, page_number""",
)
def _(spark, d):
    lines = S.split_lines(v.v_head(spark, d))
    n = F.col("line_no")
    return P.ocr_page_text(lines.select(
        "document_id", "page_number", n, F.col("line").alias("text"),
        F.when(n % 5 != 0, (n % 8) / 8.0).alias("confidence"),
    ))


@query(
    "ocr_alignment_check",
    "v_page",
    DECISION + """, d AS (SELECT document_id, page_number + CASE WHEN document_id % 19 = 0 THEN 1 ELSE 0 END AS page_number, needs_ocr FROM decisions)
    SELECT document_id, page_number, CASE WHEN d.needs_ocr IS NULL THEN 'missing_decision' WHEN p.text IS NULL THEN 'missing_page' END AS violation,
      p.text IS NOT NULL AND d.needs_ocr IS NOT NULL AND NOT d.needs_ocr AS skipped
    FROM v_page p FULL JOIN d USING (document_id, page_number)""",
)
def _(spark, d):
    pages = v.v_page(spark, d)
    shifted = F.col("page_number") + F.when(F.col("document_id") % 19 == 0, 1).otherwise(0)
    decisions = P.page_ocr_decision(pages).withColumn("page_number", shifted)
    checked = P.ocr_alignment_check(pages, decisions)
    return checked.withColumn("skipped", F.coalesce("skipped", F.lit(False)))


@query(
    "text_sample",
    "v_page",
    """SELECT document_id, substr(string_agg(text, chr(10) ORDER BY page_number), 1, 4000) AS text_sample FROM v_page
    WHERE page_number <= 5 AND trim(text, E' \\t\\n\\r') <> '' GROUP BY document_id""",
)
def _(spark, d):
    return P.text_sample(v.v_page(spark, d))


@query(
    "sheet_text_sample",
    "v_cell",
    """, c AS (SELECT document_id, page - 1 AS si, 'Sheet ' || page AS name, table_index * 100 + "row" AS r, "column" AS c, raw_text FROM v_cell),
    h AS (SELECT *, row_number() OVER (PARTITION BY document_id, si ORDER BY r, c) AS n FROM c WHERE si < 3),
    p AS (SELECT DISTINCT document_id, 0 AS part, si, 0 AS n, name AS t FROM c UNION ALL SELECT document_id, 1, si, n, raw_text FROM h WHERE n <= 40 AND raw_text <> '')
    SELECT document_id, substr(string_agg(t, chr(10) ORDER BY part, si, n), 1, 4000) AS text_sample FROM p GROUP BY document_id""",
)
def _(spark, d):
    cells = v.v_cell(spark, d).select(
        "document_id", (F.col("page") - 1).alias("sheet_index"),
        F.concat(F.lit("Sheet "), F.col("page")).alias("sheet_name"),
        (F.col("table_index") * 100 + F.col("row")).alias("row"), "column",
        F.col("raw_text").alias("value_text"),
    )
    return P.sheet_text_sample(cells)


@query(
    "blocks_from_spans",
    "v_page",
    """, l AS (SELECT document_id, page_number, string_split(text, chr(10)) AS ls, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM v_page),
    t AS (SELECT document_id, page_number, i // 2 AS block_no, i % 2 AS line_no, regexp_replace(ls[i + 1], '\\s+', ' ', 'g') AS t FROM l WHERE i // 2 <> 1 OR document_id % 4 <> 0)
    SELECT document_id, page_number, CAST(block_no AS INTEGER) AS block_no, string_agg(t, chr(10) ORDER BY line_no) AS text FROM t WHERE t <> '' GROUP BY ALL""",
)
def _(spark, d):
    lines = v.v_page(spark, d).select(
        "document_id", "page_number", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    words = F.split(F.regexp_replace("line", "\\s+", " "), "(?<= )")
    spans = lines.select(
        "document_id", "page_number", F.floor(F.col("i") / 2).cast("int").alias("block_no"),
        (F.col("i") % 2).alias("line_no"), F.posexplode(words).alias("span_no", "text"),
    )
    image = (F.col("block_no") == 1) & (F.col("document_id") % 4 == 0)
    return P.blocks_from_spans(spans.withColumn("block_type", F.when(image, 1).otherwise(0)))


CELL_TEXT = """, cr AS (SELECT document_id, page AS page_number, table_index, "row", string_agg(raw_text, ' ' ORDER BY "column") AS t FROM v_cell
    WHERE raw_text <> '' GROUP BY ALL),
  ct AS (SELECT document_id, page_number, string_agg(t, chr(10) ORDER BY table_index, "row") AS text FROM cr GROUP BY ALL)"""


@query("page_text_from_cells", "v_cell", CELL_TEXT + " SELECT * FROM ct")
def _(spark, d):
    return P.page_text_from_cells(v.v_cell(spark, d))


@query(
    "merge_page_texts",
    "v_page v_cell",
    CELL_TEXT + """ SELECT document_id, page_number, CASE WHEN c.text IS NULL THEN p.text WHEN coalesce(p.text, '') = '' THEN c.text
      ELSE p.text || chr(10) || c.text END AS text FROM v_page p FULL JOIN ct c USING (document_id, page_number)""",
)
def _(spark, d):
    return P.merge_page_texts(v.v_page(spark, d), P.page_text_from_cells(v.v_cell(spark, d)))


@query(
    "page_issues",
    "v_page v_table",
    """SELECT document_id, page_number, 'NEEDS_REVIEW' AS status, 'no_tables_detected' AS reason,
      'page has embedded images but find_tables returned none' AS detail FROM v_page p
    WHERE image_count > 0 AND NOT EXISTS (SELECT 1 FROM v_table t WHERE t.document_id = p.document_id AND t.page = p.page_number)""",
)
def _(spark, d):
    return P.page_issues(v.v_page(spark, d), v.v_table(spark, d))


@query("pages_in_order", "v_page", "SELECT document_id, page_number, text FROM v_page")
def _(spark, d):
    return P.pages_in_order(v.v_page(spark, d).select("document_id", "page_number", "text"))


# --- jobs -----------------------------------------------------------------------------------------

FOLD = """, o AS (SELECT *, status IN ('PROCESSED', 'NEEDS_REVIEW', 'FAILED') AS ended FROM v_job),
  r AS (SELECT *, row_number() OVER (PARTITION BY artifact_id ORDER BY ts DESC, event_id DESC) AS n,
    row_number() OVER (PARTITION BY artifact_id, ended OR status = 'PROCESSING' ORDER BY ts DESC, event_id DESC) AS k FROM o),
  folded AS (SELECT artifact_id, max(status) FILTER (n = 1) AS status,
    arg_max(parser, ROW(ts, event_id)) FILTER (parser IS NOT NULL AND status <> 'PENDING') AS parser,
    max(ts) FILTER (status = 'PROCESSING') AS started_at,
    max(ts) FILTER (k = 1 AND status <> 'PENDING' AND ended) AS finished_at, max(error) FILTER (k = 1 AND status <> 'PENDING' AND ended) AS error,
    min(ts) AS created_at, max(ts) AS updated_at FROM r GROUP BY artifact_id)"""


def folded(spark, d):
    return J.advance_job_state(v.v_job(spark, d).withColumnRenamed("artifact_id", "job_id"))


@query("advance_job_state", "v_job", FOLD + " SELECT artifact_id AS job_id, * EXCLUDE (artifact_id) FROM folded")
def _(spark, d):
    return folded(spark, d)


@query(
    "latest_job_per_artifact",
    "v_job",
    "SELECT artifact_id, event_id AS job_id, status, ts AS created_at FROM (SELECT *, row_number() OVER (PARTITION BY artifact_id ORDER BY ts DESC, event_id DESC) AS n FROM v_job) WHERE n = 1",
)
def _(spark, d):
    jobs = v.v_job(spark, d).select(
        "artifact_id", F.col("event_id").alias("job_id"), "status", F.col("ts").alias("created_at")
    )
    return J.latest_job_per_artifact(jobs)


@query(
    "stale_jobs",
    "v_job",
    FOLD + """, n AS (SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS now FROM folded), s AS (SELECT *, status = 'PROCESSING' AND updated_at < now - INTERVAL 3600 SECOND AS stale FROM n)
    SELECT artifact_id AS job_id, CASE WHEN stale THEN 'FAILED' ELSE status END AS status, CASE WHEN stale THEN now ELSE finished_at END AS finished_at,
      CASE WHEN stale THEN 'stale_processing_recovered' ELSE error END AS error, CASE WHEN stale THEN now ELSE updated_at END AS updated_at, stale FROM s""",
)
def _(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return J.stale_jobs(folded(spark, d), now).select(
        "job_id", "status", "finished_at", "error", "updated_at", "stale"
    )


@query(
    "company_outcome",
    "v_job v_art v_pub",
    """, j AS (SELECT artifact_id, arg_max(status, ROW(ts, event_id)) AS status FROM v_job GROUP BY artifact_id),
    o AS (SELECT p.company_id, j.status FROM v_art a JOIN v_pub p ON p.id = a.publication_id LEFT JOIN j ON j.artifact_id = CAST(string_split(a.id, '-')[3] AS BIGINT))
    SELECT company_id, count(*) FILTER (status = 'PROCESSED') AS processed, count(*) FILTER (status = 'NEEDS_REVIEW') AS needs_review,
      count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status IS NULL OR status IN ('PENDING', 'PROCESSING')) AS skipped FROM o GROUP BY company_id""",
)
def _(spark, d):
    jobs = J.latest_job_per_artifact(v.v_job(spark, d).select(
        "artifact_id", F.col("event_id").alias("job_id"), "status", F.col("ts").alias("created_at")
    ))
    artifacts = v.v_art(spark, d).withColumn("id", F.split("id", "-")[2].cast("bigint"))
    return J.company_outcome(jobs, artifacts, v.v_pub(spark, d))


@query(
    "terminal_status",
    "v_job",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 'NEEDS_REVIEW' ELSE 'PROCESSED' END AS status,
      CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN concat_ws('; ', 'note:' || event_id, CASE WHEN event_id % 3 = 0 THEN 'ocr_failed:X' END,
        CASE WHEN event_id % 5 = 0 THEN 'classification_unmatched' END, 'a', 'b', 'c', 'd', 'e', CASE WHEN event_id % 15 <> 0 THEN 'f' END) END AS error FROM v_job""",
)
def _(spark, d):
    key = F.col("event_id")
    warnings = F.array_compact(F.array(
        F.concat(F.lit("note:"), key), F.when(key % 3 == 0, "ocr_failed:X"),
        F.when(key % 5 == 0, "classification_unmatched"), *[F.lit(x) for x in "abcdefg"],
    ))
    jobs = v.v_job(spark, d).select(key, warnings.alias("w"), J.terminal_status(warnings).alias("status"))
    return jobs.select("event_id", "status", J.review_error(F.col("status"), F.col("w")).alias("error"))
