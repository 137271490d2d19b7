"""Pages: OCR decisions and quality, image coverage, text assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import values as V
from quire.functions.text import strip

PAGE = ("document_id", "page_number")


def joined(items: Column, order: tuple[str, ...], text: str, separator: str) -> Column:
    """Texts of an array of structs, in order, joined."""
    ordered = F.array_sort(F.transform(items, lambda x: F.struct(*[x[c] for c in order], x[text])))
    return F.array_join(F.transform(ordered, lambda x: x[text]), separator)


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def page_ocr_decision(
    pages: DataFrame,
    min_native_chars: int = V.MIN_NATIVE_CHARS,
    high_image_coverage: float = V.HIGH_IMAGE_COVERAGE,
    low_image_coverage: float = V.LOW_IMAGE_COVERAGE,
    policy_version: str = V.OCR_POLICY_VERSION,
) -> DataFrame:
    """Whether a page needs OCR and why; the thresholds used are kept with the answer."""
    chars, coverage = F.length(strip(F.col("text"))), F.col("image_coverage")
    reason = (
        F.when(chars >= min_native_chars, "sufficient_native_text")
        .when(coverage.isNull(), "image_coverage_unavailable")
        .when(F.col("image_coverage_error").isNotNull(), "image_coverage_incomplete")
        .when((chars == 0) & (coverage < low_image_coverage), "blank_page")
        .when(coverage >= high_image_coverage, "low_text_high_image_coverage")
        .when(chars == 0, "image_only_page")
        .otherwise("insufficient_native_text")
    )
    return pages.select(
        *PAGE, chars.alias("char_count"), "image_coverage", "image_count", "image_coverage_error",
        reason.alias("reason"),
    ).withColumns({
        "needs_ocr": ~F.col("reason").isin("sufficient_native_text", "blank_page"),
        "policy_version": F.lit(policy_version),
        "policy_min_native_chars": F.lit(min_native_chars),
        "policy_high_image_coverage": F.lit(high_image_coverage),
        "policy_low_image_coverage": F.lit(low_image_coverage),
    })


def document_ocr_decision(documents: DataFrame, decisions: DataFrame) -> DataFrame:
    """One decision per document; a document without pages needs none."""
    per_document = decisions.groupBy("document_id").agg(F.bool_or("needs_ocr").alias("any"))
    reason = (
        F.when(F.col("any").isNull(), "empty_document")
        .when(F.col("any"), "pages_require_ocr")
        .otherwise("all_pages_native_or_blank")
    )
    return documents.select("document_id").join(per_document, "document_id", "left").select(
        "document_id", F.coalesce("any", F.lit(False)).alias("needs_ocr"), reason.alias("reason")
    )


def image_coverage(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Share of the page its images cover, and why it could not be measured.

    ``images`` has one row per image: seq, xref, area (sum of its rectangles, null without any)
    and error (the failure reading them).
    """
    problem = F.when(
        F.col("error").isNotNull() | F.col("area").isNull(),
        F.concat(F.lit("xref="), F.col("xref").cast("string"), F.lit(":"),
                 F.coalesce("error", F.lit("no_rects"))),
    )
    measured = images.withColumn("problem", problem)
    # The joined problems are one value per page by definition; measured images are not collected.
    per_page = measured.groupBy(*PAGE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("problem").isNull()).alias("good"),
        F.sum(F.when(F.col("problem").isNull(), F.abs("area"))).alias("covered"),
        F.collect_list(
            F.when(F.col("problem").isNotNull(), F.struct("seq", "problem"))
        ).alias("problems"),
    )
    area = F.abs(F.col("width") * F.col("height"))
    n = F.coalesce("n", F.lit(0))
    problems = F.nullif(joined(F.col("problems"), ("seq",), "problem", "; "), F.lit(""))
    coverage = (
        F.when(n == 0, 0.0)
        .when((area > 0) & (F.col("good") > 0), F.least(F.col("covered") / area, F.lit(1.0)))
    )
    error = (
        F.when(n == 0, None)
        .when(area <= 0, "page_area_non_positive")
        .when(F.col("good") == 0, F.coalesce(problems, F.lit("image_geometry_unavailable")))
        .otherwise(problems)
    )
    return pages.select(*PAGE, "width", "height").join(per_page, list(PAGE), "left").select(
        *PAGE, coverage.alias("image_coverage"), n.cast("bigint").alias("image_count"),
        error.alias("image_coverage_error"),
    )


def ocr_quality(
    ocr_pages: DataFrame, min_confidence: float = V.MIN_OCR_CONFIDENCE,
    policy_version: str = V.OCR_QUALITY_VERSION,
) -> DataFrame:
    """Status and reason of an OCR page; the text is kept whatever they are."""
    score = F.col("confidence")
    reason = (
        F.when(is_blank(F.col("text")), "no_text_detected")
        .when(score.isNull(), "missing_confidence")
        .when(F.isnan(score) | ~score.between(0.0, 1.0), "invalid_confidence")
        .when(score < min_confidence, "low_confidence")
        .otherwise("sufficient_confidence")
    )
    return ocr_pages.withColumn("quality_reason", reason).withColumns({
        "status": F.when(F.col("quality_reason") == "sufficient_confidence", "OK").otherwise(
            "NEEDS_REVIEW"
        ),
        "quality_policy_version": F.lit(policy_version),
        "quality_policy_min_confidence": F.lit(min_confidence),
    })


def ocr_needs_review(assessed: DataFrame) -> DataFrame:
    return assessed.groupBy("document_id").agg(
        F.bool_or(F.col("status") == "NEEDS_REVIEW").alias("needs_review")
    )


def ocr_page_text(lines: DataFrame) -> DataFrame:
    """Text and mean confidence of each OCR page from its lines."""
    texts = F.collect_list(
        F.when(F.col("text") != "", F.struct("line_no", "text"))
    )
    return lines.groupBy(*PAGE).agg(
        F.avg("confidence").alias("confidence"),
        strip(joined(texts, ("line_no",), "text", "\n")).alias("text"),
    )


def ocr_alignment_check(pages: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pages and decisions matched one to one, with what is missing on either side."""
    left = pages.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("pages"))
    right = decisions.groupBy(*PAGE).agg(
        F.count(F.lit(1)).alias("decisions"), F.bool_or("needs_ocr").alias("needs_ocr")
    )
    problem = (
        F.when(F.col("decisions").isNull(), "missing_decision")
        .when(F.col("pages").isNull(), "missing_page")
        .when((F.col("pages") > 1) | (F.col("decisions") > 1), "repeated_page")
    )
    return left.join(right, list(PAGE), "full_outer").select(
        *PAGE, problem.alias("violation"),
        (problem.isNull() & ~F.col("needs_ocr")).alias("skipped"),
    )


def text_sample(
    pages: DataFrame, first_pages: int = V.TEXT_SAMPLE_PAGES, max_chars: int = V.TEXT_SAMPLE_CHARS
) -> DataFrame:
    """Start of a document: its first pages' non-blank text. At most ``first_pages`` rows a group."""
    head = pages.where((F.col("page_number") <= first_pages) & ~is_blank(F.col("text")))
    texts = F.collect_list(F.struct("page_number", "text"))
    sample = F.substring(joined(texts, ("page_number",), "text", "\n"), 1, max_chars)
    return head.groupBy("document_id").agg(sample.alias("text_sample"))


def sheet_text_sample(
    cells: DataFrame, first_sheets: int = 3, first_cells: int = 40,
    max_chars: int = V.TEXT_SAMPLE_CHARS,
) -> DataFrame:
    """Sheet names, then the first cells of the first sheets; blank cells count but add nothing."""
    order = W.partitionBy("document_id", "sheet_index").orderBy("row", "column")
    head = (
        cells.where(F.col("sheet_index") < first_sheets)
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= first_cells)
        .select("document_id", F.lit(1).alias("part"), "sheet_index", "n",
                F.col("value_text").alias("text"))
    )
    names = cells.groupBy("document_id", "sheet_index").agg(F.min("sheet_name").alias("text"))
    parts = names.select("document_id", F.lit(0).alias("part"), "sheet_index", F.lit(0).alias("n"),
                         "text").unionByName(head.where("text <> ''"))
    items = F.collect_list(F.struct("part", "sheet_index", "n", "text"))
    sample = joined(items, ("part", "sheet_index", "n"), "text", "\n")
    return parts.groupBy("document_id").agg(F.substring(sample, 1, max_chars).alias("text_sample"))


def blocks_from_spans(spans: DataFrame) -> DataFrame:
    """Text blocks from spans: spans joined as they are, non-empty lines by newline."""
    block = [*PAGE, "block_no"]
    lines = spans.where("block_type = 0").groupBy(*block, "line_no").agg(
        joined(F.collect_list(F.struct("span_no", "text")), ("span_no",), "text", "").alias("text")
    )
    texts = lines.where("text <> ''").groupBy(*block).agg(
        joined(F.collect_list(F.struct("line_no", "text")), ("line_no",), "text", "\n").alias("text")
    )
    return texts


def merge_page_texts(primary: DataFrame, extra: DataFrame) -> DataFrame:
    """Page text with the extra text after it; blanks add nothing."""
    more = extra.select(*PAGE, F.col("text").alias("more")).where("more <> ''")
    text, added = F.col("text"), F.col("more")
    merged = (
        F.when(added.isNull(), text)
        .when(F.coalesce(text, F.lit("")) == "", added)
        .otherwise(F.concat(text, F.lit("\n"), added))
    )
    return primary.select(*PAGE, "text").join(more, list(PAGE), "full_outer").select(
        *PAGE, merged.alias("text")
    )


def page_text_from_cells(cells: DataFrame) -> DataFrame:
    """Text of a page's tables: non-empty cells of a row by blank, rows by newline."""
    rows = cells.where("raw_text <> ''").groupBy("document_id", "page", "table_index", "row").agg(
        joined(F.collect_list(F.struct("column", "raw_text")), ("column",), "raw_text", " ").alias("t")
    )
    texts = F.collect_list(F.struct("table_index", "row", "t"))
    return rows.groupBy("document_id", F.col("page").alias("page_number")).agg(
        joined(texts, ("table_index", "row"), "t", "\n").alias("text")
    )


def page_issues(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """Pages with images and no table found: a table may hide in the raster."""
    with_tables = tables.select("document_id", F.col("page").alias("page_number")).distinct()
    return pages.where("image_count > 0").join(with_tables, list(PAGE), "left_anti").select(
        *PAGE, F.lit("NEEDS_REVIEW").alias("status"), F.lit("no_tables_detected").alias("reason"),
        F.lit("page has embedded images but find_tables returned none").alias("detail"),
    )


def pages_in_order(pages: DataFrame) -> DataFrame:
    return pages.orderBy(*PAGE)


def blocks_in_order(blocks: DataFrame) -> DataFrame:
    return blocks.orderBy(*PAGE, "block_index")
