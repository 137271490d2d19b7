"""Grids, quality, overlap, block numbering and table reconstruction."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import values as V
from quire.functions import tables as T
from quire.operators import cells as C
from quire.operators import pages as P
from quire.operators import reconstruct as R
from quire.operators import sections as S
from workload import views as v
from workload.page_checks import DECISION, PAGE_HITS, RULES, headed_pages, page_hits
from quire.session import new_shared_path, stored
from quire.sources.sheets import read_sheet_cells
from workload.registry import query
from workload.sql_views import fold
from workload.text_checks import amount_sql, caption_sql, period_sql, role_sql, unit_sql

_ARMS = " ".join(
    f"WHEN regexp_matches(f, '{r.pattern}') THEN '{r.name}'"
    for r in sorted(V.HEADING_RULES, key=lambda r: -r.priority)
)


def heading_sql(x: str) -> str:
    return f"(SELECT CASE WHEN length(trim({x})) NOT BETWEEN 1 AND 180 THEN NULL {_ARMS} END FROM (SELECT {fold(f'trim({x})')} AS f))"


BOXES = """, boxes AS (SELECT table_id, document_id, page, table_index, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM v_cell GROUP BY ALL)"""
QUALITY = BOXES + """, w AS (SELECT table_id, "row", count(*) AS width, count(*) FILTER (NOT has_box AND NOT is_merged) AS missing FROM v_cell GROUP BY ALL),
  g AS (SELECT table_id, min(width) <> max(width) AS jagged, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(width) AS BIGINT) AS total,
    count(*) AS row_count, max(width) AS column_count FROM w GROUP BY table_id),
  tq AS (SELECT t.table_id, t.document_id, t.page, t.table_index, g.*, b.x0 IS NULL OR t.table_index = 2 AS no_box,
      CASE WHEN t.table_index <> 2 THEN b.x0 END AS x0, CASE WHEN t.table_index <> 2 THEN b.y0 END AS y0, CASE WHEN t.table_index <> 2 THEN b.x1 END AS x1, CASE WHEN t.table_index <> 2 THEN b.y1 END AS y1
    FROM v_table t LEFT JOIN g ON g.table_id = t.table_id AND t.document_id % 12 <> 0 LEFT JOIN boxes b ON b.table_id = t.table_id),
  sc AS (SELECT *, greatest(0.05::DOUBLE, least(0.85::DOUBLE, 0.75::DOUBLE - CASE WHEN no_box THEN 0.15::DOUBLE ELSE 0 END - CASE WHEN jagged THEN 0.20::DOUBLE ELSE 0 END
      - CASE WHEN missing > 0 THEN least(0.25::DOUBLE, 0.25::DOUBLE * (missing / total)) ELSE 0 END)) AS score FROM tq),
  quality AS (SELECT table_id, document_id, page, table_index, x0, y0, x1, y1, CASE WHEN row_count IS NULL THEN 0.2::DOUBLE ELSE score END AS confidence,
    CASE WHEN row_count IS NOT NULL AND score >= 0.60 AND NOT jagged AND missing = 0 THEN 'OK' ELSE 'NEEDS_REVIEW' END AS status,
    CASE WHEN row_count IS NULL THEN 'empty_grid' ELSE concat_ws('|', CASE WHEN no_box THEN 'missing_table_bbox' END, CASE WHEN jagged THEN 'jagged_rows' END,
      CASE WHEN missing > 0 THEN 'missing_cell_bbox:' || missing || '/' || total END) END AS warnings,
    coalesce(row_count, 0) AS row_count, coalesce(column_count, 0) AS column_count FROM sc)"""


def native_tables(spark, d, cells):
    boxes = C.table_boxes(cells).select(
        "table_id", F.when(F.regexp_extract("table_id", "(\\d)$", 1).cast("int") % 3 != 2, F.col("bbox")).alias("bbox")
    )
    return v.v_table(spark, d).join(boxes, "table_id", "left")


def cell_table(spark, d):
    """The cells as a table of their own, for queries that read them several times."""
    return stored(v.v_cell(spark, d), "cells")


def quality(spark, d):
    cells = cell_table(spark, d)
    return C.table_quality(cells.where("document_id % 12 <> 0"), native_tables(spark, d, cells))


@query("table_quality", "v_cell v_table", QUALITY + """ SELECT table_id, round(confidence, 6) AS confidence, status, warnings, row_count, column_count FROM quality""")
def _(spark, d):
    return quality(spark, d).select(
        "table_id", F.round("confidence", 6).alias("confidence"), "status",
        F.array_join("warnings", "|").alias("warnings"), "row_count", "column_count",
    )


@query("table_regions", "v_cell v_table", QUALITY + """ SELECT document_id, page, table_id, x0, y0, x1, y1, round(confidence, 6) AS confidence, 'pymupdf_find_tables' AS method, status FROM quality""")
def _(spark, d):
    return C.table_regions(quality(spark, d)).select(
        "document_id", "page", "table_id", "bbox.*", F.round("confidence", 6).alias("confidence"), "method", "status"
    )


@query(
    "extraction_needs_review",
    "v_cell v_table v_page",
    QUALITY + """, f AS (SELECT document_id, status <> 'OK' AS bad FROM quality UNION ALL SELECT document_id, true FROM v_page p WHERE image_count > 0
      AND NOT EXISTS (SELECT 1 FROM v_table t WHERE t.document_id = p.document_id AND t.page = p.page_number))
    SELECT document_id, bool_or(bad) AS needs_review FROM f GROUP BY document_id""",
)
def _(spark, d):
    issues = P.page_issues(v.v_page(spark, d), v.v_table(spark, d))
    return C.extraction_needs_review(quality(spark, d), issues)


SHEET = """, sheet AS (SELECT document_id, page * 3 + table_index AS sheet_index, 'S' || page AS sheet_name, "row" + 2 AS r, "column" + 1 AS c,
    CASE WHEN raw_text <> '' AND raw_text NOT LIKE '(%' THEN raw_text END AS value_text, CASE WHEN raw_text LIKE '(%' THEN '=' || raw_text END AS formula_text,
    is_merged, chr(65 + "column") || ("row" + 2) AS address FROM v_cell WHERE is_merged OR raw_text <> '' OR "row" % 2 = 0),
  sheet2 AS (SELECT * FROM sheet UNION ALL SELECT DISTINCT document_id, 99, 'blank', 1, 1, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), true, 'A1' FROM v_cell),
  rng AS (SELECT document_id, sheet_index, min(r) FILTER (value_text IS NOT NULL OR formula_text IS NOT NULL OR is_merged) AS min_row,
    max(r) FILTER (value_text IS NOT NULL OR formula_text IS NOT NULL OR is_merged) AS max_row, min(c) FILTER (value_text IS NOT NULL OR formula_text IS NOT NULL OR is_merged) AS min_column,
    max(c) FILTER (value_text IS NOT NULL OR formula_text IS NOT NULL OR is_merged) AS max_column, NOT bool_or(value_text IS NOT NULL OR formula_text IS NOT NULL) AS is_empty FROM sheet2 GROUP BY ALL)"""


def sheet_cells(spark, d):
    cells = v.v_cell(spark, d)
    text = F.col("raw_text")
    sheet = cells.where("is_merged OR raw_text <> '' OR row % 2 = 0").select(
        "document_id", (F.col("page") * 3 + F.col("table_index")).alias("sheet_index"),
        F.concat(F.lit("S"), F.col("page")).alias("sheet_name"),
        (F.col("row") + 2).alias("row"), (F.col("column") + 1).alias("column"),
        F.when((text != "") & ~text.startswith("("), text).alias("value_text"),
        F.when(text.startswith("("), F.concat(F.lit("="), text)).alias("formula_text"),
        "is_merged",
        F.concat(F.chr(F.col("column") + 65), (F.col("row") + 2).cast("string")).alias("address"),
    )
    none = F.lit(None).cast("string")
    blank = cells.select("document_id").distinct().select(
        "document_id", F.lit(99).alias("sheet_index"), F.lit("blank").alias("sheet_name"),
        F.lit(1).alias("row"), F.lit(1).alias("column"), none.alias("value_text"),
        none.alias("formula_text"), F.lit(True).alias("is_merged"), F.lit("A1").alias("address"),
    )
    return sheet.unionByName(blank)


def sheet_table(spark, d):
    """The sheet cells as a table of their own, for queries that read them several times."""
    return stored(sheet_cells(spark, d), "sheet-cells")


@query("read_sheet_cells", "v_cell", SHEET + " SELECT document_id, sheet_index, sheet_name, r AS row, c AS \"column\", value_text, formula_text, is_merged, address FROM sheet2")
def _(spark, d):
    path = new_shared_path(spark, "sheet-cells")
    cells = sheet_cells(spark, d)
    cells.write.parquet(path)
    return read_sheet_cells(spark, path).select(*cells.columns)


@query("used_range", "v_cell", SHEET + " SELECT * FROM rng")
def _(spark, d):
    return C.used_range(sheet_cells(spark, d)).drop("sheet_name")


@query(
    "sheet_to_grid",
    "v_cell",
    SHEET + """, slots AS (SELECT document_id, sheet_index, min_row, min_column, r, unnest(range(min_column, max_column + 1)) AS c
      FROM (SELECT *, unnest(range(min_row, max_row + 1)) AS r FROM rng WHERE NOT is_empty))
    SELECT document_id || ':p' || (sheet_index + 1) || ':t0' AS table_id, CAST(r - min_row AS INTEGER) AS "row", CAST(c - min_column AS INTEGER) AS "column",
      coalesce(formula_text, value_text, '') AS raw_text, coalesce(is_merged AND formula_text IS NULL AND value_text IS NULL, false) AS is_merged,
      CASE WHEN is_merged AND formula_text IS NULL AND value_text IS NULL THEN 'merged_continuation:' || address END AS warning
    FROM slots LEFT JOIN sheet2 USING (document_id, sheet_index, r, c)""",
)
def _(spark, d):
    return C.sheet_to_grid(sheet_table(spark, d)).select("table_id", "row", "column", "raw_text", "is_merged", "warning")


@query(
    "sheet_quality",
    "v_cell",
    SHEET + """ SELECT document_id || ':p' || (sheet_index + 1) || ':t0' AS table_id, CASE WHEN is_empty THEN 0.2::DOUBLE ELSE 0.75::DOUBLE END AS confidence,
      CASE WHEN is_empty THEN 'NEEDS_REVIEW' ELSE 'OK' END AS status, CASE WHEN is_empty THEN 'empty_sheet|empty_grid' ELSE 'excel_no_page_bbox' END AS warnings FROM rng""",
)
def _(spark, d):
    cells = sheet_table(spark, d)
    assessed = C.table_quality(C.sheet_to_grid(cells, texts=False), C.sheet_tables(cells), expect_page_bboxes=False)
    return assessed.select("table_id", "confidence", "status", F.array_join("warnings", "|").alias("warnings"))


@query(
    "merge_ranges_to_cells",
    sql="""WITH m AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey % 52 AS c, l_suppkey % 40 + 1 AS r, l_orderkey % 3 AS dc, l_linenumber % 3 AS dr FROM lineitem),
    n AS (SELECT *, unnest(range(r, r + dr + 1)) AS row FROM m)
    SELECT l_orderkey, CAST(row AS INTEGER) AS row, CAST(unnest(range(c + 1, c + dc + 2)) AS INTEGER) AS "column", dc, dr FROM n""",
)
def _(spark, d):
    line = v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 52).alias("c"),
        (F.col("l_suppkey") % 40 + 1).alias("r"), (F.col("l_orderkey") % 3).alias("dc"),
        (F.col("l_linenumber") % 3).alias("dr"),
    ).distinct()

    def name(c):
        return F.concat(F.when(c >= 52, "B").when(c >= 26, "A").otherwise(""), F.chr(c % 26 + 65))

    spot = lambda c, r: F.concat(name(c), r.cast("string"))
    ranges = line.select("l_orderkey", "dc", "dr", F.concat(
        spot(F.col("c"), F.col("r")), F.lit(":"), spot(F.col("c") + F.col("dc"), F.col("r") + F.col("dr"))
    ).alias("merge_range"))
    return C.merge_ranges_to_cells(ranges).select("l_orderkey", "row", "column", "dc", "dr")


def matrices(spark, d):
    # A table has one order, by which the cells lie already: neither its rows nor their matrix is shuffled.
    table = ["l_orderkey", "table_id", "page", "document_id", "table_index"]
    rows = v.keyed_cells(spark, d).groupBy(*table, "row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("column", "raw_text"))), lambda x: x["raw_text"]).alias("texts")
    )
    box = F.struct(*(F.lit(value).alias(n) for n, value in (("x0", 50.0), ("y0", 105.0), ("x1", 545.0), ("y1", 395.0))))
    return rows.groupBy(*table).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("row", "texts"))), lambda x: x["texts"]).alias("matrix")
    ).drop("l_orderkey").withColumn("bbox", F.when(F.col("table_index") != 1, box))


@query(
    "expand_matrix",
    "v_cell",
    """, n AS (SELECT table_id, max("row") + 1 AS nr, max("column") + 1 AS nc FROM v_cell GROUP BY table_id)
    SELECT table_id, "row", "column", raw_text, CASE WHEN table_index <> 1 THEN 50 + "column" * (495.0::DOUBLE / nc) END AS x0, CASE WHEN table_index <> 1 THEN 105 + "row" * (290.0::DOUBLE / nr) END AS y0,
      table_index <> 1 AS bbox_estimated, CASE WHEN table_index = 1 THEN 'table_bbox_missing' END AS bbox_missing_warning FROM v_cell JOIN n USING (table_id)""",
)
def _(spark, d):
    return C.expand_matrix(matrices(spark, d)).select(
        "table_id", "row", "column", "raw_text", "bbox.x0", "bbox.y0", "bbox_estimated", "bbox_missing_warning"
    )


OVERLAP = BOXES + """, native AS (SELECT * FROM boxes), raw AS (SELECT 'R' || table_id AS table_id, document_id, page, table_index + 10 AS table_index,
      x0 + (document_id % 5) * 60 AS x0, y0 + table_index * 5 AS y0, x1 + (document_id % 5) * 60 AS x1, y1 + table_index * 5 AS y1, document_id % 7 = 0 AS partial FROM boxes WHERE table_index < 2),
  gone AS (SELECT DISTINCT n.table_id FROM native n JOIN raw r USING (document_id, page) WHERE NOT r.partial
    AND greatest(0, least(r.x1, n.x1) - greatest(r.x0, n.x0)) * greatest(0, least(r.y1, n.y1) - greatest(r.y0, n.y0))
      / least((r.x1 - r.x0) * (r.y1 - r.y0), (n.x1 - n.x0) * (n.y1 - n.y0)) >= 0.8)"""


def overlap_input(spark, d):
    # Native and raw boxes are read several times; the cells are gone through once.
    native = stored(C.table_boxes(v.v_cell(spark, d), "document_id", "page", "table_index"), "boxes")
    dx, dy, box = (F.col("document_id") % 5) * 60, F.col("table_index") * 5, F.col("bbox")
    raw = native.where("table_index < 2").select(
        F.concat(F.lit("R"), "table_id").alias("table_id"), "document_id", "page",
        (F.col("table_index") + 10).alias("table_index"),
        F.struct((box["x0"] + dx).alias("x0"), (box["y0"] + dy).alias("y0"), (box["x1"] + dx).alias("x1"),
                 (box["y1"] + dy).alias("y1")).alias("bbox"),
        F.array(F.when(F.col("document_id") % 7 == 0, "partial_statement_region").otherwise("x")).alias("warnings"),
    )
    return native, raw


@query("overlap_replaces_native", "v_cell", OVERLAP + " SELECT table_id FROM gone")
def _(spark, d):
    return C.overlap_replaces_native(*overlap_input(spark, d)).select("table_id")


@query(
    "merge_table_extractions",
    "v_cell",
    OVERLAP + """ SELECT table_id, document_id, page, table_index FROM native WHERE table_id NOT IN (SELECT table_id FROM gone)
      UNION ALL SELECT table_id, document_id, page, table_index FROM raw""",
)
def _(spark, d):
    return C.merge_table_extractions(*overlap_input(spark, d)).drop("bbox")


BLOCKS = DECISION + """, bl AS (SELECT document_id, page_number, 0 AS rank, unnest(range(0, len(string_split(text, chr(10))))) AS seq FROM v_page
    UNION ALL SELECT document_id, page_number, 1, 0 FROM decisions WHERE needs_ocr
    UNION ALL SELECT document_id, page, 2, table_index FROM v_table)"""


def blocks(spark, d):
    pages = v.v_page(spark, d)
    native = pages.select("document_id", "page_number", F.lit("native").alias("source"),
                          F.posexplode(F.split("text", "\n")).alias("seq", "t")).drop("t")
    ocr = P.page_ocr_decision(pages).where("needs_ocr").select(
        "document_id", "page_number", F.lit("ocr").alias("source"), F.lit(0).alias("seq"))
    tables = v.v_table(spark, d).select(
        "document_id", F.col("page").alias("page_number"), F.lit("table").alias("source"), F.col("table_index").alias("seq"))
    return native.unionByName(ocr).unionByName(tables)


@query(
    "block_index",
    "v_page v_table",
    BLOCKS + """ SELECT document_id, page_number, CASE rank WHEN 0 THEN 'native' WHEN 1 THEN 'ocr' ELSE 'table' END AS source, CAST(seq AS INTEGER) AS seq,
      row_number() OVER (PARTITION BY document_id, page_number ORDER BY rank, seq) - 1 AS block_index FROM bl""",
)
def _(spark, d):
    return C.block_index(blocks(spark, d))


@query(
    "blocks_in_order",
    "v_page v_table",
    BLOCKS + " SELECT document_id, page_number, row_number() OVER (PARTITION BY document_id, page_number ORDER BY rank, seq) - 1 AS block_index FROM bl",
)
def _(spark, d):
    return P.blocks_in_order(C.block_index(blocks(spark, d))).select("document_id", "page_number", "block_index")


# --- reconstruction -------------------------------------------------------------------------------

CARRY = """, carried AS (SELECT *, coalesce(last_value(CASE WHEN NOT is_merged THEN trim(raw_text) END IGNORE NULLS) OVER w, '') AS part,
    sum(CASE WHEN is_merged THEN 0 ELSE 1 END) OVER w AS island FROM v_cell WINDOW w AS (PARTITION BY table_id, "row" ORDER BY "column")),
  spans AS (SELECT *, CAST(CASE WHEN is_merged THEN 0 ELSE count(*) OVER (PARTITION BY table_id, "row", island) END AS INTEGER) AS span FROM carried)"""


@query("carry_merged_header", "v_cell", CARRY + ' SELECT table_id, "row", "column", part FROM carried')
def _(spark, d):
    return C.carry_merged_header(v.v_cell(spark, d)).select("table_id", "row", "column", "part")


@query("column_span", "v_cell", CARRY + ' SELECT table_id, "row", "column", span FROM spans')
def _(spark, d):
    return C.column_span(v.v_cell(spark, d)).select("table_id", "row", "column", "span")


FLAGS = CARRY + f""", rw0 AS (SELECT table_id, "row" AS r, list(trim(raw_text) ORDER BY "column") FILTER (NOT is_merged AND trim(raw_text) <> '') AS tx0 FROM v_cell GROUP BY ALL),
  rw1 AS (SELECT table_id, r, coalesce(tx0, []) AS tx, array_to_string(coalesce(tx0, []), ' ') AS joined, len(coalesce(tx0, [])) AS n FROM rw0),
  tok AS (SELECT table_id, r, t, {period_sql('t')} AS p, regexp_matches(t, '[0-9]') AS dg, {amount_sql('t')} AS am FROM (SELECT table_id, r, unnest(tx) AS t FROM rw1)),
  cnt AS (SELECT table_id, r, count(*) FILTER (p) AS np, count(*) FILTER (dg AND NOT p) AS nn, count(*) FILTER (am) AS na FROM tok GROUP BY ALL),
  dj AS (SELECT DISTINCT joined AS s FROM rw1 UNION SELECT DISTINCT tx[1] FROM rw1 WHERE n > 0),
  hd AS (SELECT s, CASE WHEN length(trim(s)) BETWEEN 1 AND 180 THEN CASE {_ARMS} END END AS rule FROM (SELECT s, {fold('trim(s)')} AS f FROM dj)),
  fl AS (SELECT w.*, coalesce(np, 0) AS n_period, coalesce(nn, 0) AS n_numeric, coalesce(na, 0) AS n_amount, n = 0 AS is_empty,
      n > 0 AND (regexp_matches(joined, '(?i)đơn\\s*vị|đvt|unit|in\\s+(?:thousands?|millions?|billions?)\\s+of') OR
        regexp_matches(joined, '(?i)((?:nghìn|nghin|triệu|trieu|tỷ|ty)\\s*đồng|(?:thousand|million|billion)s?\\s*(?:vnd|dong)|\\bvnd\\b)')) AS is_unit,
      n > 0 AND (h1.rule IS NOT NULL OR h2.rule IS NOT NULL OR (n = 1 AND NOT regexp_matches(tx[1], '[0-9]') AND length(tx[1]) >= 8)) AS is_title,
      n > 0 AND coalesce(np, 0) >= greatest(1, n - 1) AS is_period, h1.rule AS rule
    FROM rw1 w LEFT JOIN cnt USING (table_id, r) LEFT JOIN hd h1 ON h1.s = w.joined LEFT JOIN hd h2 ON h2.s = w.tx[1]),
  flags AS (SELECT *, n > 0 AND (is_period OR (n >= 2 AND n_numeric <= greatest(1, n // 3))) AS is_header, n >= 2 AND NOT is_period AND n_amount >= 1 AS is_data FROM fl)"""


@query(
    "row_flags",
    "v_cell",
    FLAGS + " SELECT table_id, r AS row, joined, CAST(n AS INTEGER) AS n_visible, CAST(n_period AS INTEGER) AS n_period, CAST(n_numeric AS INTEGER) AS n_numeric, is_empty, is_unit, is_title, is_period, is_header, is_data FROM flags",
)
def _(spark, d):
    return R.row_flags(R.table_rows(v.v_cell(spark, d))).select(
        "table_id", "row", "joined", "n_visible", "n_period", "n_numeric", "is_empty", "is_unit", "is_title",
        "is_period", "is_header", "is_data",
    )


BAND = FLAGS + """, fr AS (SELECT table_id, min(r) FILTER (NOT (is_empty OR is_unit OR is_title)) AS first_row, max(r) AS last_row FROM flags GROUP BY table_id),
  nx AS (SELECT f.table_id, f.first_row, f.last_row, coalesce(bool_or(is_header) FILTER (r = first_row), false) AS h0,
    coalesce(bool_or(is_header AND NOT is_data) FILTER (r = first_row + 1), false) AS g1, coalesce(bool_or(is_header AND NOT is_data) FILTER (r = first_row + 2), false) AS g2,
    coalesce(bool_or(is_header AND NOT is_data) FILTER (r = first_row + 3), false) AS g3, coalesce(bool_or(is_header) FILTER (r = first_row + 4), false) AS h4
    FROM fr f JOIN flags USING (table_id) GROUP BY ALL),
  bs AS (SELECT *, CASE WHEN first_row IS NULL THEN 0 WHEN NOT h0 OR NOT g1 THEN 1 WHEN NOT g2 THEN 2 WHEN NOT g3 THEN 3 ELSE 4 END AS band_size FROM nx),
  band AS (SELECT bs.*, concat_ws('|', CASE WHEN first_row IS NULL THEN 'no_header_or_body' END, CASE WHEN first_row IS NOT NULL AND NOT h0 THEN 'uncertain_header_row' END,
      CASE WHEN band_size = 4 AND h4 THEN 'oversized_header_band' END, CASE WHEN fa.is_period THEN 'header_band_incomplete' END) AS band_warnings
    FROM bs LEFT JOIN flags fa ON fa.table_id = bs.table_id AND fa.r = bs.first_row + bs.band_size)"""


@query("split_header_band", "v_cell", BAND + " SELECT table_id, first_row, band_size, band_warnings FROM band")
def _(spark, d):
    return R.split_header_band(R.row_flags(R.table_rows(v.v_cell(spark, d)))).select(
        "table_id", "first_row", "band_size", F.array_join("band_warnings", "|").alias("band_warnings")
    )


COLUMNS = BAND + f""", wd AS (SELECT b.table_id, first_row, band_size, max("column") AS mc FROM band b JOIN v_cell c ON c.table_id = b.table_id AND c."row" BETWEEN first_row AND first_row + band_size - 1 GROUP BY ALL),
  sl AS (SELECT table_id, ci, first_row + unnest(range(0, band_size)) AS r FROM (SELECT *, unnest(range(0, mc + 1)) AS ci FROM wd)),
  pt AS (SELECT sl.table_id, sl.ci, sl.r, coalesce(s.part, '') AS part, coalesce(s.span, 1) AS span FROM sl LEFT JOIN spans s ON s.table_id = sl.table_id AND s."row" = sl.r AND s."column" = sl.ci),
  cl AS (SELECT table_id, CAST(ci AS INTEGER) AS idx, coalesce(string_agg(part, ' | ' ORDER BY r) FILTER (part <> ''), '') AS header_text, string_agg(part, '~' ORDER BY r) AS header_parts, max(span) AS span FROM pt GROUP BY ALL),
  rl AS (SELECT header_text, {role_sql('header_text')} AS role FROM (SELECT DISTINCT header_text FROM cl)),
  cols AS (SELECT * FROM cl JOIN rl USING (header_text)),
  pick AS (SELECT table_id, coalesce(min(idx) FILTER (role = 'label'), min(idx) FILTER (role NOT IN ('index', 'code', 'note'))) AS label_at,
    count(*) FILTER (role = 'label') <> 1 AS ambiguous FROM cols GROUP BY table_id)"""


def rebuilt(spark, d):
    cells = cell_table(spark, d)
    tables = C.table_quality(cells, native_tables(spark, d, cells))
    pages, hits = headed_pages(spark, d), page_hits(spark, d)
    return R.reconstruct_tables(cells, tables, pages.select("document_id", "page_number", "text"), S.section_hints(hits)), cells


@query("build_columns", "v_cell", COLUMNS + ' SELECT table_id, idx AS "index", header_text, header_parts, span, role FROM cols')
def _(spark, d):
    return rebuilt(spark, d)[0].columns.select(
        "table_id", "index", "header_text", F.array_join("header_parts", "~").alias("header_parts"), "span", "role"
    )


@query("pick_label_column", "v_cell", COLUMNS + " SELECT table_id, label_at AS label_column_index, CASE WHEN ambiguous THEN 'ambiguous_label_column' END AS label_warning FROM pick")
def _(spark, d):
    return R.pick_label_column(rebuilt(spark, d)[0].columns).select("table_id", "label_column_index", "label_warning")


BODY = COLUMNS + """, bc AS (SELECT c.table_id, c."row" AS r, c."column" AS ci, c.raw_text, c.is_merged, k.role, p.label_at FROM v_cell c JOIN band b USING (table_id) JOIN pick p USING (table_id)
      LEFT JOIN cols k ON k.table_id = c.table_id AND k.idx = c."column" WHERE c."row" >= b.first_row + b.band_size),
  vc AS (SELECT c.table_id, c.idx FROM cols c JOIN pick p USING (table_id) WHERE c.role = 'value' AND (p.label_at IS NULL OR c.idx <> p.label_at)),
  br AS (SELECT table_id, r, any_value(label_at) AS label_at, coalesce(max(raw_text) FILTER (ci = label_at AND NOT is_merged), '') AS label,
    coalesce(bool_or(is_merged) FILTER (ci = label_at), false) AS merged_label, string_agg(raw_text, '~' ORDER BY ci) AS by_col,
    coalesce(bool_or(trim(raw_text) <> '') FILTER (NOT is_merged), false) AS shown,
    coalesce(bool_and(trim(raw_text) = '' OR regexp_matches(raw_text, '^[\\s\\-–—_=.*]+$')) FILTER (NOT is_merged), true) AS ruled FROM bc GROUP BY table_id, r),
  bv AS (SELECT br.table_id, br.r, string_agg(coalesce(c.raw_text, ''), '~' ORDER BY vc.idx) AS vals, bool_or(trim(coalesce(c.raw_text, '')) <> '') AS has_value
    FROM br JOIN vc USING (table_id) LEFT JOIN v_cell c ON c.table_id = br.table_id AND c."row" = br.r AND c."column" = vc.idx GROUP BY ALL),
  body AS (SELECT br.*, coalesce(vals, '') AS vals, CASE WHEN NOT shown THEN 'empty' WHEN ruled THEN 'separator' WHEN merged_label THEN 'continuation'
      WHEN trim(label) <> '' AND NOT coalesce(has_value, false) THEN 'section_header' ELSE 'data' END AS kind FROM br LEFT JOIN bv USING (table_id, r))"""


@query("body_rows", "v_cell", BODY + " SELECT table_id, r AS row_index, label, vals AS \"values\", by_col AS cells_by_column, kind, CAST(length(label) - length(ltrim(label)) AS INTEGER) AS indent_spaces, label_at AS label_column_index FROM body")
def _(spark, d):
    return rebuilt(spark, d)[0].rows.withColumns(
        {"values": F.array_join("values", "~"), "cells_by_column": F.array_join("cells_by_column", "~")}
    )


_QUALITY_ALL = QUALITY.replace(" AND t.document_id % 12 <> 0", "")
_PH = PAGE_HITS
TABLES = (
    BODY + _QUALITY_ALL + _PH.replace("hits AS (SELECT document_id", "hits AS (SELECT document_id")
    + f""", hint AS (SELECT document_id, page_number AS page, min(section) AS section_hint, count(DISTINCT section) AS ns FROM hits GROUP BY ALL),
  pbest AS (SELECT document_id, page_number AS page, section, trim(line) AS t, confidence FROM (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY priority DESC, line_no) AS n FROM heads) WHERE n = 1),
  pwhole AS (SELECT document_id, page_number AS page, substr(trim(text, E' \\t\\n\\r'), 1, 180) AS t FROM vh),
  pwr AS (SELECT document_id, page, t, CASE {_ARMS} END AS matched_rule FROM (SELECT *, {fold("trim(t, E' \\t\\n\\r')")} AS f FROM pwhole)),
  pctx AS (SELECT vh.document_id, vh.page_number AS page, coalesce(b.section, r.section) AS s_section, coalesce(b.t, CASE WHEN r.section IS NOT NULL THEN w.t END) AS s_text,
      coalesce(b.confidence, r.confidence) AS s_conf, coalesce(h.ns, 0) AS ns, CASE WHEN h.ns = 1 THEN h.section_hint END AS hint, {unit_sql('vh.text')} AS s_unit
    FROM vh LEFT JOIN pbest b ON b.document_id = vh.document_id AND b.page = vh.page_number LEFT JOIN pwr w ON w.document_id = vh.document_id AND w.page = vh.page_number
      LEFT JOIN rules r ON r.matched_rule = w.matched_rule LEFT JOIN hint h ON h.document_id = vh.document_id AND h.page = vh.page_number),
  ih AS (SELECT table_id, section AS i_section, joined AS i_text, confidence AS i_conf FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY priority DESC, r) AS k
    FROM flags f JOIN rules u ON u.matched_rule = f.rule) WHERE k = 1),
  blob AS (SELECT table_id, string_agg(joined, chr(10) ORDER BY r) AS txt FROM flags GROUP BY table_id),
  iw AS (SELECT table_id, t, CASE {_ARMS} END AS wrule FROM (SELECT table_id, t, {fold('t')} AS f FROM (SELECT table_id, substr(trim(txt, E' \\t\\n\\r'), 1, 180) AS t FROM blob))),
  cu AS (SELECT table_id, {unit_sql('txt')} AS c_unit FROM blob),
  cx AS (SELECT q.*, p.s_section, p.s_text, p.s_conf, coalesce(p.ns, 0) AS ns, p.hint, p.s_unit, cu.c_unit, coalesce(ih.i_section, ru.section) AS i_section,
      coalesce(ih.i_text, CASE WHEN ru.section IS NOT NULL THEN iw.t END) AS i_text, coalesce(ih.i_conf, ru.confidence) AS i_conf, b.first_row, b.band_size, b.band_warnings, k.label_at, k.ambiguous,
      (SELECT count(*) FROM body y WHERE y.table_id = q.table_id AND y.kind = 'data') AS nd
    FROM quality q LEFT JOIN pctx p ON p.document_id = q.document_id AND p.page = q.page LEFT JOIN ih ON ih.table_id = q.table_id LEFT JOIN cu ON cu.table_id = q.table_id
      LEFT JOIN iw ON iw.table_id = q.table_id LEFT JOIN rules ru ON ru.matched_rule = iw.wrule
      LEFT JOIN band b ON b.table_id = q.table_id LEFT JOIN pick k ON k.table_id = q.table_id),
  ty AS (SELECT *, ns > 1 AND i_section IS NULL AND hint IS NULL AS unclear, coalesce(c_unit, s_unit) AS unit_text FROM cx),
  ty2 AS (SELECT *, coalesce(i_section, hint, CASE WHEN NOT unclear THEN s_section END, 'unknown') AS table_type,
      CASE WHEN i_section IS NOT NULL THEN i_conf WHEN hint IS NOT NULL THEN 0.70::DOUBLE WHEN NOT unclear THEN s_conf END AS type_confidence,
      CASE WHEN i_section IS NOT NULL THEN i_text WHEN hint IS NOT NULL THEN hint WHEN NOT unclear THEN s_text END AS type_matched_text,
      coalesce(i_section IS NOT NULL AND (hint <> i_section OR (NOT unclear AND s_section <> i_section)), false) AS conflict FROM ty),
  wn AS (SELECT *, concat_ws('|', nullif(warnings, ''), CASE WHEN unclear THEN 'ambiguous_section_context' END, CASE WHEN conflict THEN 'conflicting_table_type' END, nullif(band_warnings, ''),
      CASE WHEN ambiguous THEN 'ambiguous_label_column' END, CASE WHEN table_type = 'unknown' THEN 'unknown_table_type' END, CASE WHEN unit_text IS NULL THEN 'missing_unit_text' END,
      CASE WHEN first_row IS NOT NULL AND nd = 0 THEN 'empty_body' END) AS w1 FROM ty2),
  rebuilt AS (SELECT *, CASE WHEN regexp_matches('|' || w1 || '|', '\\|({"|".join(V.REVIEW_WARNINGS)})[:|]') OR status <> 'OK' OR (table_type <> 'unknown' AND unit_text IS NULL)
      THEN 'NEEDS_REVIEW' ELSE 'OK' END AS final_status, w1 || CASE WHEN status <> 'OK' THEN CASE WHEN w1 = '' THEN '' ELSE '|' END || 'raw_extraction_not_ok' ELSE '' END AS final_warnings FROM wn)"""
)


@query(
    "reconstruct_tables",
    "v_cell v_table v_page",
    TABLES + """ SELECT table_id, table_type, unit_text, type_confidence, type_matched_text, final_status AS status, final_warnings AS warnings,
      array_to_string(list_transform(range(first_row, first_row + band_size), lambda x: CAST(x AS VARCHAR)), ',') AS header_rows, label_at AS label_column_index FROM rebuilt""",
)
def _(spark, d):
    return rebuilt(spark, d)[0].tables.select(
        "table_id", "table_type", "unit_text", "type_confidence", "type_matched_text", "status",
        F.array_join("warnings", "|").alias("warnings"),
        F.array_join(F.col("header_band_row_indices").cast("array<string>"), ",").alias("header_rows"),
        "label_column_index",
    )


@query(
    "resolve_table_type",
    "v_cell v_table v_page",
    TABLES + " SELECT table_id, table_type, type_confidence, type_matched_text, concat_ws('|', CASE WHEN unclear THEN 'ambiguous_section_context' END, CASE WHEN conflict THEN 'conflicting_table_type' END) AS type_warnings FROM rebuilt",
)
def _(spark, d):
    flagged = R.row_flags(R.table_rows(v.v_cell(spark, d)))
    context = (
        v.v_table(spark, d).join(R._text_digest(flagged), "table_id", "left")
        .join(R.surrounding_context(headed_pages(spark, d)), ["document_id", "page"], "left")
        .join(S.section_hints(page_hits(spark, d)), ["document_id", "page"], "left")
    )
    return R.resolve_table_type(context).select(
        "table_id", "table_type", "type_confidence", "type_matched_text",
        F.array_join("type_warnings", "|").alias("type_warnings"),
    )
