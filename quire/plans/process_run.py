"""One document-processing run over every requested document at once."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.tables import BBOX
from quire.operators import cells as C
from quire.operators import ingest as I
from quire.operators import jobs as J
from quire.operators import pages as P
from quire.operators import reconstruct as R
from quire.operators import sections as S
from quire.session import cut_lineage


SHOWN_WARNINGS = 8


class Processed(NamedTuple):
    """Documents, pages, blocks and sections of a run, and its rebuilt tables.

    A block has its type, box and content. The content is JSON; that of a table names the table, whose
    payload comes in parts of bounded size from ``reconstruct.table_intermediate_json``.
    """

    documents: DataFrame
    pages: DataFrame
    blocks: DataFrame
    sections: DataFrame
    reconstruction: R.Reconstruction


def first_warnings(warnings: DataFrame, limit: int = SHOWN_WARNINGS) -> DataFrame:
    """Status and error per document from its warnings, one row each with its position.

    Only the first ``limit`` of a document are brought together; the status looks at all of them.
    """
    distinct = warnings.groupBy("document_id", "warning").agg(
        F.min(F.struct("rank", "page", "table_index")).alias("at")
    )
    review = distinct.groupBy("document_id").agg(
        F.bool_or(J.terminal_status(F.array("warning")) == "NEEDS_REVIEW").alias("review")
    )
    order = W.partitionBy("document_id").orderBy("at", "warning")
    top = distinct.withColumn("n", F.row_number().over(order)).where(F.col("n") <= limit)
    texts = F.array_sort(F.collect_list(F.struct("n", "warning")))
    firsts = top.groupBy("document_id").agg(
        F.array_join(F.transform(texts, lambda x: x["warning"]), "; ").alias("error")
    )
    return review.join(firsts, "document_id").select(
        "document_id", F.when(F.col("review"), "NEEDS_REVIEW").otherwise("PROCESSED").alias("status"),
        F.when(F.col("review"), F.col("error")).alias("error"),
    )


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def _noted(df: DataFrame, rank: int, text: Column, page: str | None = None, index: str | None = None) -> DataFrame:
    zero = F.lit(0)
    return df.select(
        "document_id", F.lit(rank).alias("rank"), (zero if page is None else F.col(page)).alias("page"),
        (zero if index is None else F.col(index)).alias("table_index"), text.alias("warning"),
    )


def _sidecar_warnings(wanted: DataFrame, raw_warnings: DataFrame) -> DataFrame:
    """Every requested document with the warnings of sidecar files that could not be read.

    No file can be told to belong to another document, so each document gets them; more than a document
    shows would change nothing, so as many of them are taken, first by path.
    """
    first = [r["warning"] for r in raw_warnings.orderBy("path").limit(SHOWN_WARNINGS).collect()]
    return wanted.select("document_id", F.explode(F.array(*map(F.lit, first)).cast("array<string>")).alias("warning"))


def _text_blocks(blocks: DataFrame, source: str, *content: str) -> DataFrame:
    fields = [F.lit(source).alias("source"), *(_column(blocks, c, "string") for c in content)]
    return blocks.select(
        "document_id", "page_number", F.lit(source).alias("source"), _column(blocks, "seq", "int").alias("seq"),
        F.lit("text").alias("block_type"), _column(blocks, "bbox", BBOX).alias("bbox"),
        F.to_json(F.struct(*fields)).alias("content"))


def _table_blocks(rebuilt: DataFrame, tables: DataFrame, *more: str) -> DataFrame:
    """One block per rebuilt table, in the order of the tables of its page."""
    boxes = tables.select("table_id", _column(tables, "bbox", BBOX).alias("bbox"),
                          *(_column(tables, c, "string") for c in more))
    fields = [F.lit("table_reconstruction").alias("source"), F.col("status"), F.col("warnings"), F.col("table_id")]
    names = [F.col("source_label").alias("sheet_name")] if more else []
    return rebuilt.select("document_id", "page", "table_index", "table_id", "status", "warnings").join(
        boxes, "table_id").select(
        "document_id", F.col("page").alias("page_number"), F.lit("table").alias("source"),
        F.col("table_index").alias("seq"), F.lit("table").alias("block_type"), "bbox",
        F.to_json(F.struct(*fields, *names)).alias("content"))


def _finished(classes: DataFrame, needs_ocr: DataFrame, notes: list[DataFrame]) -> DataFrame:
    warnings = notes[0]
    for more in notes[1:]:
        warnings = warnings.unionByName(more)
    return (
        classes.select("document_id", "document_class").join(needs_ocr, "document_id")
        .join(first_warnings(warnings), "document_id", "left")
        .withColumn("status", F.coalesce("status", F.lit("PROCESSED")))
    )


def process_pages(
    requests: DataFrame, pages: DataFrame, page_blocks: DataFrame, tables: DataFrame,
    cells: DataFrame, ocr_pages: DataFrame | None = None, raw_tables: DataFrame | None = None,
    raw_cells: DataFrame | None = None, raw_warnings: DataFrame | None = None,
    classify: Callable[[DataFrame], DataFrame] = S.classify_documents,
    reconstruct: Callable[..., R.Reconstruction] = R.reconstruct_tables,
) -> Processed:
    """OCR decision, class, sections, tables, blocks and status of every requested document.

    ``tables`` and ``cells`` are what was found in the documents; ``raw_tables`` and ``raw_cells``
    are bound sidecars, which replace a found table only where they cover it; ``raw_warnings`` (path,
    warning) are sidecar files that failed. Without ``ocr_pages`` no OCR engine is configured: a document
    that needs OCR says so and goes to review. ``classify`` and ``reconstruct`` can be replaced. What
    several later steps read is checkpointed once: tables, sections, classes and rebuilt tables.
    """
    wanted = requests.select("document_id")
    keep = lambda df: df.join(wanted, "document_id", "left_semi")
    pages, tables, cells = keep(pages), keep(tables), keep(cells)
    notes: list[DataFrame] = []

    decisions = P.page_ocr_decision(pages)
    document_decision = cut_lineage(P.document_ocr_decision(wanted, decisions))
    native_text = pages.select("document_id", "page_number", "text")
    assessed = None
    if ocr_pages is None:
        notes.append(_noted(document_decision.where("needs_ocr"), 1, F.lit("ocr_required_but_engine_not_configured")))
        sample = P.text_sample(native_text)
    else:
        needed = decisions.where("needs_ocr").select(
            "document_id", "page_number", F.col("reason").alias("decision_reason"))
        assessed = cut_lineage(P.ocr_quality(ocr_pages.join(needed, ["document_id", "page_number"])))
        notes.append(_noted(P.ocr_needs_review(assessed).where("needs_review"), 1, F.lit("ocr_needs_review")))
        # Native pages come before recognised ones in the sample.
        both = P.text_sample(native_text).select("document_id", F.lit(0).alias("part"), "text_sample")
        first = W.partitionBy("document_id").orderBy("page_number")
        recognised = assessed.withColumn("n", F.row_number().over(first)).where("n <= 5").select(
            "document_id", F.col("n").alias("page_number"), "text")
        both = both.unionByName(
            P.text_sample(recognised).select("document_id", F.lit(1).alias("part"), "text_sample"))
        sample = both.groupBy("document_id").agg(F.substring(
            P.joined(F.collect_list(F.struct("part", "text_sample")), ("part",), "text_sample", "\n"),
            1, 4000).alias("text_sample"))

    classes = cut_lineage(classify(requests.join(sample, "document_id", "left").select(
        "document_id", "title", "filename", "text_sample",
        F.create_map(F.lit("document_type"), "document_type").alias("metadata"),
    )))
    notes.append(_noted(classes.where("reason = 'unmatched_needs_llm'"), 2, F.lit("classification_unmatched")))

    sections = S.collect_section_hits(native_text)
    if assessed is not None:
        sections = S.merge_section_hits(sections, S.collect_section_hits(assessed))
    texts, issues = native_text, P.page_issues(pages, tables)
    if raw_tables is not None:
        raw_tables, raw_cells = cut_lineage(keep(raw_tables)), keep(raw_cells)
        raw_text = P.page_text_from_cells(raw_cells)
        texts = P.merge_page_texts(native_text, raw_text)
        sections = S.merge_section_hits(sections, S.collect_section_hits(raw_text))
        tables = C.merge_table_extractions(tables, raw_tables)
        columns = ["table_id", "row", "column", "raw_text", "is_merged"]
        kept = cells.select(*columns).join(tables.select("table_id"), "table_id", "left_semi")
        cells = kept.unionByName(raw_cells.select(*columns))
    tables, sections = cut_lineage(tables), cut_lineage(sections)
    failed_files = None
    if raw_warnings is not None:
        failed_files = _sidecar_warnings(wanted, raw_warnings)
        notes.append(_noted(failed_files, 3, F.col("warning")))
    review = C.extraction_needs_review(tables, issues, failed_files)
    notes.append(_noted(review.where("needs_review"), 4, F.lit("table_extraction_needs_review")))

    rebuilt = reconstruct(cells, tables, texts, S.section_hints(sections))
    rebuilt = rebuilt._replace(tables=cut_lineage(rebuilt.tables))
    notes.append(_noted(rebuilt.tables.where("status = 'NEEDS_REVIEW'"), 5,
                        F.concat(F.lit("table_reconstruction_needs_review:"), "table_id"), "page", "table_index"))

    blocks = _text_blocks(page_blocks, "native", "text", "parser_name", "parser_version")
    if assessed is not None:
        blocks = blocks.unionByName(_text_blocks(
            assessed.withColumn("seq", F.lit(0)), "ocr", "engine", "engine_version", "text", "confidence", "status",
            "quality_reason", "decision_reason"))
    blocks = blocks.unionByName(_table_blocks(rebuilt.tables, tables))
    blocks = I.drop_orphan_blocks(C.block_index(keep(blocks)), pages)

    documents = _finished(classes, document_decision.select("document_id", "needs_ocr"), notes)
    native_pages = pages.select(
        "document_id", "page_number", "text", F.lit("native").alias("extraction_method"),
        F.lit(None).cast("double").alias("ocr_confidence"), "width", "height")
    return Processed(documents, native_pages, blocks, sections, rebuilt)


def process_workbooks(
    requests: DataFrame, sheet_cells: DataFrame,
    classify: Callable[[DataFrame], DataFrame] = S.classify_documents,
    reconstruct: Callable[..., R.Reconstruction] = R.reconstruct_tables,
) -> Processed:
    """The same for workbooks: a page per sheet with the sheet's name as text, a table per sheet, no OCR."""
    cells = sheet_cells.join(requests.select("document_id"), "document_id", "left_semi")
    sample = P.sheet_text_sample(cells)
    classes = cut_lineage(classify(requests.join(sample, "document_id", "left").select(
        "document_id", "title", "filename", "text_sample",
        F.create_map(F.lit("document_type"), "document_type").alias("metadata"),
    )))
    sections = cut_lineage(S.sheet_section_hits(cells))
    grid = C.sheet_to_grid(cells)
    shape = C.sheet_to_grid(cells, texts=False)
    tables = cut_lineage(C.table_quality(shape, C.sheet_tables(cells), expect_page_bboxes=False))
    pages = cells.groupBy("document_id", (F.col("sheet_index") + 1).alias("page_number")).agg(
        F.min("sheet_name").alias("text")).withColumns({
            "extraction_method": F.lit("native"), "ocr_confidence": F.lit(None).cast("double"),
            "width": F.lit(1.0), "height": F.lit(1.0)})
    texts = pages.select("document_id", "page_number", "text")
    rebuilt = reconstruct(grid, tables, texts, S.section_hints(sections))
    rebuilt = rebuilt._replace(tables=cut_lineage(rebuilt.tables))
    review = tables.groupBy("document_id").agg(F.bool_or(F.col("status") != "OK").alias("needs_review"))
    notes = [
        _noted(classes.where("reason = 'unmatched_needs_llm'"), 2, F.lit("classification_unmatched")),
        _noted(review.where("needs_review"), 4, F.lit("table_extraction_needs_review")),
        _noted(rebuilt.tables.where("status = 'NEEDS_REVIEW'"), 5,
               F.concat(F.lit("table_reconstruction_needs_review:"), "table_id"), "page", "table_index"),
    ]
    blocks = C.block_index(_table_blocks(rebuilt.tables, tables.drop("bbox"), "source_label"))
    no_ocr = requests.select("document_id", F.lit(None).cast("boolean").alias("needs_ocr"))
    return Processed(_finished(classes, no_ocr, notes), pages, blocks, sections, rebuilt)


def unsupported_documents(requests: DataFrame) -> DataFrame:
    """Outcome of the requests whose ``file_type`` is neither PDF nor XLSX: nothing is read from them."""
    old = F.col("file_type") == "XLS"
    kind = F.coalesce("file_type", F.lit("unknown"))
    return requests.where(~F.coalesce(F.col("file_type").isin("PDF", "XLSX"), F.lit(False))).select(
        "document_id", F.lit(None).cast("string").alias("document_class"),
        F.lit(None).cast("boolean").alias("needs_ocr"),
        F.when(old, "NEEDS_REVIEW").otherwise("FAILED").alias("status"),
        F.when(old, "XLS is detected but only XLSX parsing is implemented").otherwise(
            F.concat(F.lit("unsupported file type: "), kind)).alias("error"),
        F.when(old, "xls_not_supported_use_xlsx").otherwise("unsupported_file_type").alias("warning"))


def process_documents(
    requests: DataFrame, pages: DataFrame, page_blocks: DataFrame, tables: DataFrame, cells: DataFrame,
    sheet_cells: DataFrame, **options: object,
) -> DataFrame:
    """(document_id, document_class, needs_ocr, status, error) of every request by its ``file_type``."""
    of_type = lambda kind: requests.where(F.col("file_type") == kind)
    pdf = process_pages(of_type("PDF"), pages, page_blocks, tables, cells, **options)
    sheets = process_workbooks(of_type("XLSX"), sheet_cells)
    columns = ["document_id", "document_class", "needs_ocr", "status", "error"]
    return pdf.documents.select(*columns).unionByName(sheets.documents.select(*columns)).unionByName(
        unsupported_documents(requests).select(*columns))
