"""Table cells: grids from matrices and sheets, quality, regions, overlap, block numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import values as V
from quire.functions.tables import BBOX, make_table_id, matrix_cell_bbox

SHEET = ("document_id", "sheet_index")


def expand_matrix(tables: DataFrame) -> DataFrame:
    """Cells of ragged text matrices, each with its equal share of the table box.

    A row without cells stays visible as one row with a null column.
    """
    box = F.col("bbox")
    width = F.array_max(F.transform("matrix", lambda row: F.size(row)))
    rows = tables.select(
        "table_id", "page", box, F.size("matrix").alias("row_count"), width.alias("column_count"),
        F.posexplode("matrix").alias("row", "texts"),
    )
    cells = rows.select("*", F.posexplode_outer("texts").alias("column", "raw_text"))
    share = matrix_cell_bbox(
        box, F.col("row"), F.col("column"), F.col("row_count"), F.col("column_count")
    )
    return cells.select(
        "table_id", "page", "row", "column",
        F.when(F.col("column").isNotNull(), F.coalesce("raw_text", F.lit("None"))).alias("raw_text"),
        F.lit(False).alias("is_merged"),
        share.alias("bbox"), box.isNotNull().alias("bbox_estimated"),
        F.when(box.isNull(), "table_bbox_missing").alias("bbox_missing_warning"),
    )


def merge_ranges_to_cells(ranges: DataFrame) -> DataFrame:
    """Every coordinate inside a range such as A1:B2."""
    corner = "^([A-Z]+)([0-9]+):([A-Z]+)([0-9]+)$"
    part = lambda i: F.regexp_extract("merge_range", corner, i)

    def number(letters: Column) -> Column:
        return F.aggregate(
            F.split(letters, ""), F.lit(0), lambda n, c: n * 26 + F.ascii(c) - 64
        )

    boxes = ranges.where(F.col("merge_range").rlike(corner)).select(
        "*", F.explode(F.sequence(part(2).cast("int"), part(4).cast("int"))).alias("row"),
        number(part(1)).alias("first"), number(part(3)).alias("last"),
    )
    return boxes.select(*ranges.columns, "row", F.explode(F.sequence("first", "last")).alias("column"))


def _filled() -> Column:
    return F.col("value_text").isNotNull() | F.col("formula_text").isNotNull()


def used_range(cells: DataFrame) -> DataFrame:
    """Rectangle of the cells with a value, a formula or a merge; a sheet of none is flagged empty."""
    populated = _filled() | F.col("is_merged")
    ends = {
        f"{end}_{axis}": function(F.when(populated, F.col(axis)))
        for axis in ("row", "column") for end, function in (("min", F.min), ("max", F.max))
    }
    empty = ~F.coalesce(F.bool_or(_filled()), F.lit(False))
    return cells.groupBy(*SHEET).agg(
        *[value.alias(name) for name, value in ends.items()], empty.alias("is_empty"),
        F.min("sheet_name").alias("sheet_name"),
    )


def sheet_to_grid(cells: DataFrame, texts: bool = True) -> DataFrame:
    """Dense 0-based grid of every sheet's used range.

    A missing cell is empty text. A merged cell without its own value continues its neighbour and
    carries a warning. Formulas keep their text. A row's cells are brought together and its empty slots
    are added where the row lies, so the slots are not shuffled; a row has at most 16,384 columns.
    Without ``texts`` the grid has its shape only, for what counts cells, and no text is shuffled.
    """
    ranges = used_range(cells).where(~F.col("is_empty")).drop("is_empty", "sheet_name")
    slots = ranges.select("*", F.explode(F.sequence("min_row", "max_row")).alias("row"))
    continuation = F.coalesce("is_merged", F.lit(False)) & ~_filled()
    said = [
        F.coalesce("formula_text", "value_text", F.lit("")).alias("raw_text"),
        F.when(continuation, F.concat(F.lit("merged_continuation:"), "address")).alias("warning"),
    ] if texts else []
    blank = [F.lit("").alias("raw_text"), F.lit(None).cast("string").alias("warning")] if texts else []
    cell = F.struct("column", continuation.alias("is_merged"), *said)
    own = cells.groupBy(*SHEET, "row").agg(F.collect_list(cell).alias("own"))
    kind = own.schema["own"].dataType
    used = F.filter("own", lambda c: c["column"].between(F.col("min_column"), F.col("max_column")))
    used = F.coalesce(used, F.array().cast(kind))
    missing = F.array_except(F.sequence("min_column", "max_column"), F.transform("used", lambda c: c["column"]))
    empty = F.transform(missing, lambda c: F.struct(c.alias("column"), F.lit(False).alias("is_merged"), *blank))
    grid = slots.join(own, [*SHEET, "row"], "left").withColumn("used", used).select(
        *SHEET, "row", "min_row", "min_column", F.inline(F.concat("used", empty.cast(kind))))
    return grid.select(
        make_table_id(F.col("sheet_index") + 1, F.lit(0), document_id=F.col("document_id")).alias("table_id"),
        "document_id", (F.col("sheet_index") + 1).alias("page"), F.lit(0).alias("table_index"),
        (F.col("row") - F.col("min_row")).alias("row"),
        (F.col("column") - F.col("min_column")).alias("column"),
        *(["raw_text"] if texts else []), "is_merged",
        F.lit(None).cast(BBOX).alias("bbox"),
        F.lit("excel_has_no_page_bbox").alias("bbox_missing_warning"),
        *(["warning"] if texts else []),
    )


def sheet_tables(cells: DataFrame) -> DataFrame:
    """Header of each sheet's one table; an empty sheet has a table without cells."""
    return used_range(cells).select(
        make_table_id(F.col("sheet_index") + 1, F.lit(0), document_id=F.col("document_id")).alias("table_id"),
        "document_id", (F.col("sheet_index") + 1).alias("page"), F.lit(0).alias("table_index"),
        F.col("sheet_name").alias("source_label"), F.lit(None).cast(BBOX).alias("bbox"),
        F.when(F.col("is_empty"), F.array(F.lit("empty_sheet"))).otherwise(
            F.array(F.lit("excel_no_page_bbox"))
        ).alias("warnings"),
    )


def table_quality(
    cells: DataFrame, tables: DataFrame, expect_page_bboxes: bool = True
) -> DataFrame:
    """Confidence, status and warnings of every table.

    Row widths first, then tables: both levels combine before they shuffle.
    """
    no_box = F.col("bbox").isNull() & ~F.col("is_merged")
    widths = cells.groupBy("table_id", "row").agg(
        F.count("column").alias("width"),
        F.count_if(F.col("column").isNotNull() & no_box).alias("missing"),
    )
    grids = widths.groupBy("table_id").agg(
        (F.min("width") != F.max("width")).alias("jagged"),
        F.sum("missing").alias("missing"),
        F.greatest(F.sum("width"), F.lit(1)).alias("total"),
        F.count(F.lit(1)).alias("row_count"), F.max("width").alias("column_count"),
    )
    expect = F.lit(expect_page_bboxes)
    empty, jagged = F.col("row_count").isNull(), F.coalesce("jagged", F.lit(False))
    no_table_box = expect & F.col("bbox").isNull()
    missing = F.when(expect, F.coalesce("missing", F.lit(0))).otherwise(0)
    score = F.lit(0.75)
    score = F.when(no_table_box, score - 0.15).otherwise(score)
    score = F.when(jagged, score - 0.20).otherwise(score)
    score = F.when(
        missing > 0, score - F.least(F.lit(0.25), 0.25 * (missing / F.col("total")))
    ).otherwise(score)
    score = F.greatest(F.lit(0.05), F.least(F.lit(0.85), score))
    ok = ~empty & (score >= 0.60) & ~jagged & (missing == 0)
    known = F.col("warnings") if "warnings" in tables.columns else F.array().cast("array<string>")
    added = F.when(empty, F.array(F.lit("empty_grid"))).otherwise(F.array_compact(F.array(
        F.when(no_table_box, "missing_table_bbox"),
        F.when(jagged, "jagged_rows"),
        F.when(missing > 0, F.concat(
            F.lit("missing_cell_bbox:"), missing.cast("string"), F.lit("/"),
            F.col("total").cast("string"))),
    )))
    kept = [c for c in tables.columns if c not in ("warnings", "confidence", "status")]
    return tables.join(grids, "table_id", "left").select(
        *kept,
        F.when(empty, 0.2).otherwise(score).alias("confidence"),
        F.when(ok, "OK").otherwise("NEEDS_REVIEW").alias("status"),
        F.concat(known, added).alias("warnings"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
    )


def table_boxes(cells: DataFrame, *keep: str) -> DataFrame:
    """Smallest box around a table's cells."""
    box = F.struct(
        F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"),
        F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1"),
    )
    return cells.groupBy("table_id", *keep).agg(
        F.when(F.count("bbox") > 0, box).cast(BBOX).alias("bbox")
    )


def table_regions(tables: DataFrame, method: str = "pymupdf_find_tables") -> DataFrame:
    """Region of each table; the confidence is the table's own and is never invented."""
    return tables.select(
        "document_id", "page", "table_id", "bbox", "confidence", F.lit(method).alias("method"),
        "status", "warnings",
    )


def extraction_needs_review(
    tables: DataFrame, issues: DataFrame, warnings: DataFrame | None = None
) -> DataFrame:
    """Documents with a warning, a table that is not OK, or an issue to review."""
    flags = tables.select("document_id", (F.col("status") != "OK").alias("bad")).unionByName(
        issues.select("document_id", (F.col("status") == "NEEDS_REVIEW").alias("bad"))
    )
    if warnings is not None:
        flags = flags.unionByName(warnings.select("document_id", F.lit(True).alias("bad")))
    return flags.groupBy("document_id").agg(F.bool_or("bad").alias("needs_review"))


# --- overlapping tables ---------------------------------------------------------------------------

_LEVELS = 12  # grid steps of 1, 4, 16 … 4^12 points: wider than any page


def _grid_keys(box: Column, level: Column) -> Column:
    """Grid squares a box touches at a level: at most four, if it is no larger than a square."""
    step = F.pow(F.lit(4.0), level)
    at = lambda side: F.floor(box[side] / step).cast("bigint")
    return F.flatten(F.transform(
        F.sequence(at("x0"), at("x1")),
        lambda gx: F.transform(
            F.sequence(at("y0"), at("y1")), lambda gy: F.struct(gx.alias("gx"), gy.alias("gy"))
        ),
    ))


def _on_grid(boxes: DataFrame, own_only: bool) -> DataFrame:
    box = F.col("bbox")
    size = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"], F.lit(1.0))
    own = F.least(F.ceil(F.log2(size) / 2), F.lit(_LEVELS)).cast("int")
    levels = F.array(own) if own_only else F.sequence(own, F.lit(_LEVELS))
    placed = boxes.select("*", own.alias("own"), F.explode(levels).alias("level"))
    return placed.select("*", F.explode(_grid_keys(box, F.col("level"))).alias("g")).select(
        *boxes.columns, "own", "level", "g.gx", "g.gy"
    )


def overlap_replaces_native(
    native: DataFrame, raw: DataFrame, min_overlap: float = V.REPLACE_OVERLAP
) -> DataFrame:
    """Native tables a full raw grid covers: intersection over the smaller area at least 0.8.

    Boxes meet on a grid whose square fits the larger of the two, so a crowded page never pairs all
    its boxes. Equal boxes are compared once.
    """
    page = ["document_id", "page"]
    full = raw.where(~F.array_contains("warnings", "partial_statement_region"))
    mine = native.where("bbox IS NOT NULL").select(*page, "bbox").distinct()
    other = full.where("bbox IS NOT NULL").select(*page, "bbox").distinct()
    on = [*page, "level", "gx", "gy"]

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        renamed = right.withColumnsRenamed({"bbox": "other", "own": "other_own"})
        return left.join(renamed, on)

    pairs = meet(_on_grid(mine, True), _on_grid(other, False)).unionByName(
        # The other way round, only where the raw box is the strictly larger one.
        meet(_on_grid(mine, False).where("level > own"), _on_grid(other, True))
    )
    a, b = F.col("bbox"), F.col("other")
    zero = F.lit(0.0)
    across = F.greatest(zero, F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    down = F.greatest(zero, F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda x: (x["x1"] - x["x0"]) * (x["y1"] - x["y0"])
    smaller = F.least(area(a), area(b))
    covered = pairs.where((smaller > 0) & (across * down / smaller >= min_overlap))
    return native.join(covered.select(*page, "bbox").distinct(), [*page, "bbox"], "left_semi")


def grid_sizes(cells: DataFrame) -> DataFrame:
    """(table_id, row_count, column_count): rows, and slots of the widest."""
    return cells.groupBy("table_id", "row").agg(F.count("column").alias("width")).groupBy("table_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("width").alias("column_count"))


def merge_table_extractions(native: DataFrame, raw: DataFrame) -> DataFrame:
    """Native tables that no full raw grid covers, and all raw ones. Order them where they are written."""
    replaced = overlap_replaces_native(native, raw).select("table_id")
    kept = native.join(replaced, "table_id", "left_anti")
    same = [F.col(c) if c in raw.columns else F.lit(None).cast(native.schema[c].dataType).alias(c)
            for c in native.columns]
    return kept.unionByName(raw.select(*same))


def bind_sidecars(documents: DataFrame, sidecars: DataFrame, cells: DataFrame):
    """Sidecar tables and cells bound to every document of their digest, with that document's identity.

    The tables carry their row and column counts; the cells carry document, page and table index.
    """
    identity = documents.select(
        "document_id", "artifact_id", "source_sha256", F.col("source_label").alias("bound_label")
    )
    bound = sidecars.drop("document_id", "artifact_id").withColumnRenamed(
        "declared_sha256", "source_sha256"
    ).join(identity, "source_sha256")
    bound = bound.join(grid_sizes(cells), "table_id", "left").withColumns({
        c: F.coalesce(c, F.lit(0)) for c in ("row_count", "column_count")})
    bound = bound.withColumn("bound_id", make_table_id(
        F.col("page"), F.col("table_index"), document_id=F.col("document_id"),
        artifact_id=F.col("artifact_id"), source_sha256=F.col("source_sha256"), sidecar=True,
    ))
    ids = bound.select("table_id", "bound_id", "document_id", "table_index")
    bound_cells = cells.drop("document_id", "table_index").join(ids, "table_id").drop("table_id")
    tables = bound.drop("table_id", "source_label").withColumns({"extractor_name": F.lit("json_raw_table")})
    rename = lambda df: df.withColumnsRenamed(
        {"bound_id": "table_id", "bound_label": "source_label"})
    return rename(tables), rename(bound_cells)


# --- ordering -------------------------------------------------------------------------------------

_STRETCH = 4096


def number_within(
    df: DataFrame, keys: Sequence[str], rank: str, seq: str, name: str
) -> DataFrame:
    """0-based position within each key by (rank, seq), without one task per key.

    Rows are numbered within stretches of ``seq``; the sizes of earlier stretches are added. ``seq``
    is an integer, unique within (key, rank).
    """
    stretch = df.withColumn("stretch", F.floor(F.col(seq) / _STRETCH))
    part = [*keys, rank, "stretch"]
    before = W.partitionBy(*keys).orderBy(rank, "stretch").rowsBetween(W.unboundedPreceding, -1)
    starts = stretch.groupBy(*part).agg(F.count(F.lit(1)).alias("size")).withColumn(
        "start", F.coalesce(F.sum("size").over(before), F.lit(0))
    )
    inside = F.row_number().over(W.partitionBy(*part).orderBy(seq)) - 1
    return (
        stretch.withColumn("inside", inside)
        .join(starts.drop("size"), part)
        .withColumn(name, F.col("start") + F.col("inside"))
        .select(*df.columns, name)
    )


def block_index(blocks: DataFrame) -> DataFrame:
    """Blocks numbered per page: native text, then OCR, then tables."""
    rank = F.when(F.col("source") == "native", 0).when(F.col("source") == "ocr", 1).otherwise(2)
    numbered = number_within(
        blocks.withColumn("rank", rank), ["document_id", "page_number"], "rank", "seq", "block_index"
    )
    return numbered.drop("rank")


# --- header rows ----------------------------------------------------------------------------------


def carry_merged_header(cells: DataFrame) -> DataFrame:
    """``part``: a merged slot takes the last real text to its left, which may be blank."""
    from quire.functions.text import strip

    left = W.partitionBy("table_id", "row").orderBy("column").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    own = F.when(~F.col("is_merged"), strip(F.col("raw_text")))
    return cells.withColumn("part", F.coalesce(F.last(own, ignorenulls=True).over(left), F.lit("")))


def column_span(cells: DataFrame) -> DataFrame:
    """``span``: one plus the merged slots that follow a real cell, zero on a merged slot."""
    row = W.partitionBy("table_id", "row").orderBy("column")
    island = F.sum(F.when(F.col("is_merged"), 0).otherwise(1)).over(
        row.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    numbered = cells.withColumn("island", island)
    size = F.count(F.lit(1)).over(W.partitionBy("table_id", "row", "island"))
    return numbered.withColumn(
        "span", F.when(F.col("is_merged"), 0).otherwise(size).cast("int")
    ).drop("island")
