"""The same views as plain SQL for the oracle."""

from __future__ import annotations

from workload.views import HEADER_CELLS, HEADINGS, JOB_STATUS, TITLES


def quote(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def pick(index: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"(CASE {index} {arms} END)"


def fold(x: str) -> str:
    mapped = f"replace(replace(replace({x}, 'đ', 'd'), 'Đ', 'd'), 'ß', 'ss')"
    return f"translate(lower(strip_accents({mapped})), '_-.', '   ')"


V_PUB = """v_pub AS (
  SELECT o_orderkey AS id, o_custkey AS company_id, 'SRC' || (o_custkey % 3) AS source,
    'ord-' || o_orderkey AS source_document_id,
    CASE o_orderkey % 5 WHEN 0 THEN 'periodic_report' WHEN 1 THEN 'financial_statement'
      WHEN 2 THEN 'event_disclosure' WHEN 3 THEN 'material_disclosure' ELSE 'other' END AS document_type,
    o_orderpriority AS title,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS published_at,
    CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_orderdate AS DATE) END AS source_updated_date,
    CASE WHEN o_orderkey % 17 = 0 THEN 'DATE' END AS published_at_precision,
    CASE o_orderkey % 4 WHEN 0 THEN 'consolidated' WHEN 1 THEN 'parent' WHEN 2 THEN 'standalone' ELSE 'unknown' END AS scope,
    CASE o_orderkey % 3 WHEN 0 THEN 'audited' WHEN 1 THEN 'unaudited' ELSE 'unknown' END AS audit_status,
    CASE WHEN o_orderkey % 2 = 0 THEN 'vi' END AS language,
    'ref/' || o_orderkey AS source_reference,
    'ord-' || (CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN -1
      WHEN o_orderkey % 7 = 0 THEN lag(o_orderkey, 2) OVER w ELSE lag(o_orderkey, 1) OVER w END) AS supersedes,
    o_orderkey % 3 = 0 AS is_correction, o_orderdate AS updated_at
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""

V_ART = """v_art AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
    l_orderkey AS publication_id, 'att-' || l_linenumber AS attachment_reference,
    'file-' || l_partkey || (CASE l_partkey % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' ELSE '.xlsx' END) AS filename,
    CASE WHEN l_partkey % 4 = 0 THEN 'application/pdf' ELSE 'application/octet-stream' END AS mime_type,
    CAST(l_quantity * 100 AS BIGINT) AS file_size, sha256(CAST(l_partkey AS VARCHAR)) AS sha256,
    l_shipdate AS created_at
  FROM lineitem)"""

V_PAGE = """v_page0 AS (
  SELECT doc_id, lang, string_split(text, chr(10)) AS ls,
    unnest(range(0, (len(string_split(text, chr(10))) - 1) // 4 + 1)) AS p FROM documents),
v_page1 AS (
  SELECT doc_id, lang, CAST(p + 1 AS INTEGER) AS page_number,
    array_to_string(ls[p * 4 + 1 : p * 4 + 4], chr(10)) AS t FROM v_page0),
v_page AS (
  SELECT doc_id AS document_id, page_number, lang,
    CASE (doc_id * 7 + page_number) % 9 WHEN 0 THEN '' WHEN 1 THEN substr(t, 1, 20) ELSE t END AS text,
    CAST(595 AS DOUBLE) AS width, CAST(842 AS DOUBLE) AS height,
    CASE WHEN doc_id % 11 <> 0 THEN CAST(doc_id % 10 AS DOUBLE) / 20.0 * ((doc_id + page_number) % 2) END AS image_coverage,
    CAST((doc_id + page_number) % 2 AS INTEGER) AS image_count,
    CASE WHEN doc_id % 13 = 0 THEN 'xref=1:no_rects' END AS image_coverage_error
  FROM v_page1)"""

V_HEAD = f"""v_head AS (
  SELECT doc_id AS document_id, CAST(doc_id % 5 + 1 AS INTEGER) AS page_number,
    {pick('doc_id % 8', HEADINGS)} || text AS text, {pick('doc_id % 7', TITLES)} AS title,
    'file_' || doc_id || (CASE WHEN doc_id % 6 = 0 THEN '_bctc.pdf' ELSE '.pdf' END) AS filename,
    CASE doc_id % 4 WHEN 0 THEN 'periodic_report' WHEN 1 THEN 'event_disclosure' WHEN 2 THEN ' Other ' END AS document_type,
    lang, source AS origin
  FROM documents)"""

V_LINE = """v_line0 AS (
  SELECT l_orderkey, l_linenumber, min(ROW(l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_returnflag, l_linestatus)) AS v
  FROM lineitem GROUP BY ALL),
v_line AS (
  SELECT l_orderkey, l_linenumber, v[1] AS l_partkey, v[2] AS l_suppkey, v[3] AS l_shipdate, v[4] AS l_extendedprice,
    v[5] AS l_returnflag, v[6] AS l_linestatus,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1
      + (CASE l_orderkey % 4 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END) AS INTEGER) AS row
  FROM v_line0)"""

_KEYS = """'T' || l_orderkey AS table_id, l_orderkey // 10 AS document_id,
    CAST((l_orderkey % 10) // 3 + 1 AS INTEGER) AS page, CAST((l_orderkey % 10) % 3 AS INTEGER) AS table_index"""

V_TABLE = f"v_table AS (SELECT DISTINCT {_KEYS} FROM lineitem)"

_HEADS = ", ".join(
    f"({v}, {r}, {c}, {quote(t)}, {str(m).lower()})" for v, r, c, t, m in HEADER_CELLS
)

V_CELL = V_LINE + f""",
v_heads(variant, "row", "column", raw_text, is_merged) AS (VALUES {_HEADS}),
v_cell0 AS (
  SELECT o.l_orderkey, h."row", h."column", h.raw_text, h.is_merged, false AS no_box
  FROM (SELECT DISTINCT l_orderkey FROM lineitem) o JOIN v_heads h ON o.l_orderkey % 4 = h.variant
  UNION ALL
  SELECT l_orderkey, "row", c,
    CASE WHEN l_partkey % 37 = 0 THEN '---'
      WHEN c = 0 AND l_partkey % 41 = 0 THEN ''
      WHEN c = 0 THEN (CASE WHEN l_partkey % 5 = 0 THEN '  ' ELSE '' END) || l_returnflag || ' ' || l_linestatus
      WHEN c = 1 THEN CAST(l_partkey % 1000 AS VARCHAR)
      WHEN c = 2 OR l_partkey % 31 = 0 THEN ''
      WHEN c = 3 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
      ELSE '(' || (l_suppkey * 1000) || ')' END,
    (c = 0 AND l_partkey % 41 = 0 OR c = 2 AND l_partkey % 13 = 0) AND l_partkey % 37 <> 0,
    l_partkey % 29 = 0
  FROM v_line, (SELECT unnest(range(0, 5)) AS c)
  WHERE NOT (c = 4 AND l_suppkey % 19 = 0)),
v_cell AS (
  SELECT {_KEYS}, "row", CAST("column" AS INTEGER) AS "column", raw_text, is_merged,
    NOT no_box AND NOT is_merged AS has_box,
    CASE WHEN has_box THEN "column" * 100.0::DOUBLE + 50 END AS x0, CASE WHEN has_box THEN "row" * 20.0::DOUBLE + 100 END AS y0,
    CASE WHEN has_box THEN "column" * 100.0::DOUBLE + 150 END AS x1, CASE WHEN has_box THEN "row" * 20.0::DOUBLE + 120 END AS y1
  FROM v_cell0)"""

V_CARD = """v_card0 AS (
  SELECT page_id, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages),
v_card AS (
  SELECT page_id, html || array_to_string(list_transform(range(1, len(links) + 1), lambda i:
      '<div><span class="t"> ' || (CASE i WHEN 1 THEN 'Information disclosure '
        WHEN 2 THEN 'Audited consolidated financial statements '
        ELSE 'information disclosures unaudited separate financial statement ' END) || title
      || '</span><span>Updated<!-- -->: <!-- -->'
      || (CASE WHEN i = 3 THEN 'soon' ELSE (page_id % 12 + 1) || '/' || (page_id % 28 + 1) || '/2024' END)
      || '</span><a href="/api/download?url=https%3A%2F%2Fexample.com' || replace(links[i], '/', '%2F')
      || '.pdf">Download</a></div>'), chr(10)) AS html
  FROM v_card0)"""

_STATUS = " ".join(f"WHEN '{event}' THEN '{status}'" for event, status in JOB_STATUS.items())
V_JOB = f"""v_job AS (
  SELECT event_id, user_id AS artifact_id, CASE event_type {_STATUS} END AS status, ts,
    CASE WHEN event_id % 3 = 0 THEN 'native' END AS parser,
    CASE WHEN event_type = 'error' THEN 'boom ' || event_id END AS error, value
  FROM events)"""

ALL = {
    "v_pub": V_PUB, "v_art": V_ART, "v_page": V_PAGE, "v_head": V_HEAD, "v_line": V_LINE,
    "v_table": V_TABLE, "v_cell": V_CELL, "v_card": V_CARD, "v_job": V_JOB,
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the named views. ``body`` may start with its own CTEs after a comma."""
    ctes = ", ".join(ALL[name] for name in names.split())
    return f"WITH RECURSIVE {ctes}{body}" if body.startswith(",") else f"WITH {ctes} {body}"
