"""Financial tables from raw cells: header band, columns, rows, type, unit, status.

A table is handled as rows in chunks of consecutive rows. Cells are shuffled once, by (table, chunk);
a chunk is reduced to a small digest, the digests of a table to its header, and the header goes back
to the chunks. A very long table is thus spread over many tasks, and no task holds all its rows.
A row of cells is at most as wide as a sheet: 16,384 columns. Row numbers are positions from zero.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import values as V
from quire.functions import tables as T
from quire.functions.text import LINE_BREAK, bind, computed_once, extracted, may_match, strip
from quire.operators.cells import carry_merged_header, column_span
from quire.operators.sections import (
    best_heading,
    distinct_sections,
    heading_rule,
    lines_with_breaks,
    text_headings,
)
from quire.session import stored

CHUNK_ROWS = 512
_PERIOD, _WORD, _SMALL, _AMOUNT = range(4)  # what a cell's text is
_BORDER_ROWS = 5  # a unit caption has at most five words or signs, so it crosses at most five rows


class Reconstruction(NamedTuple):
    tables: DataFrame
    columns: DataFrame
    rows: DataFrame


def table_rows(cells: DataFrame) -> DataFrame:
    """One record per table row: its cells in order, its visible texts, the texts joined, and how many of
    them are periods, figures and amounts. Cells are tested before they are brought together."""
    text, shown = F.col("text"), F.col("text") != ""
    placed = (
        cells.select("table_id", "row", "column", "raw_text", "is_merged")
        .withColumn("chunk", F.floor(F.col("row") / CHUNK_ROWS).cast("int"))
        .repartition("table_id", "chunk")
        .withColumn("text", F.when(~F.col("is_merged"), strip(F.col("raw_text"))))
        # A test is made only where those before it leave the answer open.
        .withColumn("is", F.when(shown & T.bare_is_period(text), _PERIOD).when(~(shown & T.has_digit(text)), _WORD)
                    .when(T.bare_is_small_number(text), _SMALL).when(shown, _AMOUNT))
    )
    cell = F.struct("column", "raw_text", "is_merged")
    rows = placed.groupBy("table_id", "chunk", "row").agg(
        F.sort_array(F.collect_list(F.when(F.col("column").isNotNull(), cell))).alias("cells"),
        F.sort_array(F.collect_list(
            F.when(F.col("column").isNotNull() & shown, F.struct("column", "text")))).alias("texts"),
        F.count_if(F.col("is") == _PERIOD).alias("n_period"), F.count_if(F.col("is") >= _SMALL).alias("n_numeric"),
        F.count_if(F.col("is") == _AMOUNT).alias("n_amount"),
    )
    return rows.withColumn("texts", F.col("texts.text")).withColumn("joined", F.array_join("texts", " "))


def row_flags(rows: DataFrame) -> DataFrame:
    """What a row looks like: empty, unit, title, period line, header, data."""
    texts, joined = F.col("texts"), F.col("joined")
    n = F.size(texts)
    counted = rows.withColumns({
        "n_visible": n, **{name: F.col(name).cast("int") for name in ("n_period", "n_numeric", "n_amount")}})
    first = F.get(texts, F.lit(0))
    counted = counted.withColumn("rule", F.when(n > 0, heading_rule(joined)))
    lone = (n == 1) & ~T.has_digit(first) & (F.length(first) >= 8)
    title = F.col("rule").isNotNull() | lone | F.when(
        n > 1, heading_rule(first).isNotNull()).otherwise(False)
    period = (n > 0) & (F.col("n_period") >= F.greatest(F.lit(1), n - 1))
    third = F.greatest(F.lit(1), F.floor(n / 3))
    return counted.withColumns({
        "is_empty": n == 0,
        "is_unit": (n > 0) & T.has_unit(joined),
        "is_title": (n > 0) & title,
        "is_period": period,
        "is_header": (n > 0) & (period | ((n >= 2) & (F.col("n_numeric") <= third))),
        "is_data": (n >= 2) & ~period & (F.col("n_amount") >= 1),
    })


def _with_heading(flagged: DataFrame) -> DataFrame:
    """``heading``: the heading of a row, the best one if it has several lines."""
    one_line = ~F.col("joined").rlike(LINE_BREAK)
    headings = F.filter(
        F.transform(lines_with_breaks(F.col("joined")), lambda line, i: F.struct(
            heading_rule(line).alias("rule"), i.alias("line_no"), strip(line).alias("text"))),
        lambda x: x["rule"].isNotNull(),
    )
    own = F.struct("rule", F.lit(0).alias("line_no"), F.col("joined").alias("text"))
    # A row on one line was tested as a whole already.
    heading = F.when(one_line, F.array_compact(F.array(F.when(F.col("rule").isNotNull(), own)))).otherwise(
        headings)
    ranked = F.array_min(F.transform(heading, lambda x: F.struct(
        (-x["rule"]["priority"]).alias("rank"), F.col("row").alias("row"),
        x["line_no"].alias("line_no"), x["rule"]["section"].alias("section"),
        x["text"].alias("matched_text"), x["rule"]["confidence"].alias("confidence"))))
    return flagged.withColumn("heading", F.when(F.col("n_visible") > 0, ranked))


def _chunk_text() -> dict[str, Column]:
    """Aggregates of a chunk: its best heading, and its lines in order."""
    line = F.when(F.col("n_visible") > 0, F.struct("row", "joined"))
    return {"heading": F.min("heading"), "lines": F.sort_array(F.collect_list(line))}


def _chunk_text_digest() -> list[Column]:
    """What is kept of a chunk's lines."""
    lines = F.col("lines.joined")
    text = F.array_join(lines, "\n")
    return [
        F.substring(text, 1, V.MAX_HEADING_CHARS).alias("start"),
        extracted(text, V.UNIT_CAPTION, "isU").alias("caption"),
        extracted(text, V.UNIT_SCALE, "iU").alias("scale"),
        F.endswith(text, extracted(text, V.UNIT_CAPTION, "isU")).alias("open"),
        F.slice(lines, 1, _BORDER_ROWS).alias("first"),
        F.array_join(F.reverse(F.slice(F.reverse(lines), 1, _BORDER_ROWS)), "\n").alias("last"),
    ]


def _table_text() -> dict[str, Column]:
    """Aggregates of a table: its best heading, and the digests of its chunks with text."""
    digest = F.struct("chunk", "start", "caption", "scale", "open", "first", "last")
    spoken = F.when(F.size("first") > 0, digest)
    return {"heading": F.min("heading"), "chunks": F.sort_array(F.collect_list(spoken))}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _text_digest(flagged: DataFrame) -> DataFrame:
    """Per table: unit text of its cells, best heading row, and the start of its text."""
    chunks = _with_heading(flagged).groupBy("table_id", "chunk").agg(*_named(_chunk_text()))
    chunks = chunks.select("table_id", "chunk", "heading", *_chunk_text_digest())
    return _read_texts(chunks.groupBy("table_id").agg(*_named(_table_text())))


def _read_texts(digests: DataFrame, *more: str) -> DataFrame:
    """Unit text and own heading of every table from the digests of its chunks."""
    def across(pattern: str, flags: str, chunk: Column, i: Column) -> Column:
        """A match that starts in the last rows of a chunk and may run into the next ones."""
        following = F.flatten(
            F.transform(F.slice(F.col("chunks"), i + 2, F.lit(_BORDER_ROWS)), lambda c: c["first"])
        )
        border = F.concat_ws("\n", chunk["last"], F.array_join(F.slice(following, 1, _BORDER_ROWS), "\n"))
        flagged = f"(?{flags}){pattern}"

        def begun(text: Column) -> Column:
            starts_here = F.regexp_instr(text, F.lit(flagged)) <= F.length(chunk["last"])
            return F.when(may_match(text, pattern) & starts_here,
                          F.nullif(F.regexp_extract(text, flagged, 1), F.lit("")))

        return bind(border, begun)

    captions = F.transform("chunks", lambda c, i: F.when(
        (c["caption"] != "") & ~c["open"], c["caption"]).otherwise(across(V.UNIT_CAPTION, "isU", c, i)))
    scales = F.transform("chunks", lambda c, i: F.when(
        c["scale"] != "", c["scale"]).otherwise(across(V.UNIT_SCALE, "iU", c, i)))
    first_of = lambda found: F.get(F.array_compact(found), F.lit(0))
    start = F.substring(
        F.array_join(F.transform("chunks", lambda c: c["start"]), "\n"), 1, V.MAX_HEADING_CHARS
    )
    whole = heading_rule(F.col("start"))
    unit = F.coalesce(T.unit_caption(F.col("caption")), F.nullif(strip(F.col("scale")), F.lit("")))
    internal = F.coalesce(
        F.when(F.col("heading").isNotNull(), F.struct(
            F.col("heading.section").alias("section"),
            F.col("heading.matched_text").alias("matched_text"),
            F.col("heading.confidence").alias("confidence"))),
        F.when(whole.isNotNull(), F.struct(
            whole["section"].alias("section"), F.col("start").alias("matched_text"),
            whole["confidence"].alias("confidence"))),
    )
    return digests.select(
        "table_id", *more, "heading", start.alias("start"), first_of(captions).alias("caption"),
        first_of(scales).alias("scale"),
    ).select("table_id", *more, unit.alias("cell_unit"), internal.alias("internal"))


_LOOK = V.MAX_HEADER_ROWS + 1


def _skipped() -> Column:
    return F.col("is_empty") | F.col("is_unit") | F.col("is_title")


def _chunk_flags(with_cells: bool) -> dict[str, Column]:
    """Aggregates of a chunk: the flags of its rows, and its first row that is not skipped.

    Cells come along for rows that can follow in a band, and for that first row.
    """
    follows = F.col("is_header") & ~F.col("is_data")
    cells = [F.when(follows, F.col("cells")).alias("cells")] if with_cells else []
    flag = F.struct("row", _skipped().alias("skip"), "is_header", "is_data", "is_period", *cells)
    first = {"first_found": F.min(F.when(~_skipped(), F.struct("row", "cells")))} if with_cells else {}
    return {"flags": F.sort_array(F.collect_list(flag)), **first}


def _chunk_heads(with_cells: bool) -> list[Column]:
    """What is kept of a chunk's flags: its first rows, and those from the first that is not skipped."""
    start = F.array_position(F.transform("flags", lambda f: ~f["skip"]), True).cast("int")
    first = [F.col("first_found.cells").alias("first_cells")] if with_cells else []
    return [F.slice("flags", 1, _LOOK).alias("head"),
            F.when(start > 0, F.slice("flags", start, _LOOK)).alias("found"), *first]


def _table_flags(with_cells: bool) -> dict[str, Column]:
    first = ["first_cells"] if with_cells else []
    return {"c": F.sort_array(F.collect_list(F.struct("chunk", "head", "found", *first))),
            "last_chunk": F.max("chunk")}


def split_header_band(flagged: DataFrame) -> DataFrame:
    """Header band of every table: first row, number of rows, warnings; no band is a null first row.

    Leading empty, unit and title rows are skipped. At most four rows follow that look like a
    header; the first one is taken alone, as uncertain, if it does not.
    """
    chunks = flagged.groupBy("table_id", "chunk").agg(*_named(_chunk_flags(False)))
    chunks = chunks.select("table_id", "chunk", *_chunk_heads(False))
    return _read_bands(chunks.groupBy("table_id").agg(*_named(_table_flags(False))), False)


def _read_bands(tables: DataFrame, with_cells: bool, *more: str) -> DataFrame:
    """Header band of every table from the flags of its chunks; with cells also its rows."""
    at = F.array_position(F.transform("c", lambda x: x["found"].isNotNull()), True).cast("int")
    later = F.flatten(F.transform(
        F.slice(F.col("c"), F.col("at") + 1, F.lit(_LOOK)), lambda x: x["head"]))
    found = F.get("c", F.col("at") - 1)
    five = F.slice(F.concat(found["found"], later), 1, _LOOK)
    first = [F.when(F.col("at") > 0, found["first_cells"]).alias("first_cells")] if with_cells else []
    tables = tables.withColumn("at", at).select(
        "table_id", *more, "last_chunk", F.when(F.col("at") > 0, five).alias("w"), *first,
    )
    w = F.col("w")
    flag_at = lambda i, name: F.coalesce(F.get(w, F.lit(i))[name], F.lit(False))
    goes_on = lambda i: flag_at(i, "is_header") & ~flag_at(i, "is_data")
    size = (
        F.when(w.isNull(), 0)
        .when(~flag_at(0, "is_header") | ~goes_on(1), 1)
        .when(~goes_on(2), 2)
        .when(~goes_on(3), 3)
        .otherwise(V.MAX_HEADER_ROWS)
    )
    tables = tables.withColumn("band_size", size)
    after = F.get(w, F.col("band_size"))
    warnings = F.array_compact(F.array(
        F.when(w.isNull(), "no_header_or_body"),
        F.when(w.isNotNull() & ~flag_at(0, "is_header"), "uncertain_header_row"),
        F.when((F.col("band_size") == V.MAX_HEADER_ROWS) & flag_at(V.MAX_HEADER_ROWS, "is_header"),
               "oversized_header_band"),
        F.when(w.isNotNull() & F.coalesce(after["is_period"], F.lit(False)), "header_band_incomplete"),
    ))
    band_rows = [F.transform(F.slice(w, F.lit(1), F.col("band_size")), lambda f: F.struct(
        f["row"].alias("row"), F.coalesce(f["cells"], F.col("first_cells")).alias("cells"))).alias("band_rows")
    ] if with_cells else []
    return tables.select(
        "table_id", *more, "last_chunk", F.get(w, F.lit(0))["row"].alias("first_row"), "band_size",
        warnings.alias("band_warnings"), *band_rows,
    )


def table_digests(flagged: DataFrame) -> DataFrame:
    """Band with its cells, unit and own heading of every table: the rows are gone through once."""
    chunks = _with_heading(flagged).groupBy("table_id", "chunk").agg(
        *_named(_chunk_flags(True)), *_named(_chunk_text()))
    chunks = chunks.select("table_id", "chunk", "heading", *_chunk_heads(True), *_chunk_text_digest())
    tables = chunks.groupBy("table_id").agg(*_named(_table_flags(True)), *_named(_table_text()))
    bands = _read_bands(tables, True, "heading", "chunks")
    return _read_texts(bands, "last_chunk", "first_row", "band_size", "band_warnings", "band_rows")


def build_columns(band_cells: DataFrame) -> DataFrame:
    """Columns of the header band: carried parts, joined text, role and span."""
    parts = column_span(carry_merged_header(band_cells))
    rows = F.array_sort(F.collect_list(F.struct("row", "part", "span", "is_merged")))
    # A row too short for this column gives a blank part and a span of one.
    grouped = parts.groupBy("table_id", "column", "first_row", "band_size").agg(rows.alias("rows"))
    slots = F.transform(
        F.sequence(F.col("first_row"), F.col("first_row") + F.col("band_size") - 1),
        lambda r: F.get(F.filter(F.col("rows"), lambda x: x["row"] == r), F.lit(0)),
    )
    header_parts = F.transform(slots, lambda s: F.coalesce(s["part"], F.lit("")))
    span = F.array_max(F.transform(slots, lambda s: F.coalesce(s["span"], F.lit(1))))
    text = F.array_join(F.filter(header_parts, lambda p: p != ""), " | ")
    return grouped.select(
        "table_id", F.col("column").alias("index"), text.alias("header_text"),
        header_parts.alias("header_parts"), span.alias("span"),
    ).withColumn("role", T.column_role(F.col("header_text")))


def pick_label_column(columns: DataFrame) -> DataFrame:
    """Label column of every table, its value columns, and a warning when it had to be guessed."""
    role, index = F.col("role"), F.col("index")
    picked = columns.groupBy("table_id").agg(
        F.min(F.when(role == "label", index)).alias("label"),
        F.count_if(role == "label").alias("labels"),
        F.min(F.when(~role.isin("index", "code", "note"), index)).alias("guess"),
        # A sheet has at most 16,384 columns.
        F.array_sort(F.collect_list(F.when(role == "value", index))).alias("values"),
    )
    label = F.coalesce("label", "guess")
    return picked.select(
        "table_id", label.alias("label_column_index"),
        F.filter("values", lambda i: label.isNull() | (i != label)).alias("value_indexes"),
        F.when(F.col("labels") != 1, "ambiguous_label_column").alias("label_warning"),
    )


def body_rows(rows: DataFrame) -> DataFrame:
    """Label, values, kind and indent of the rows below the band."""
    cells, label_at = F.col("cells"), F.col("label_column_index")
    label_cell = F.when(label_at.isNotNull(), F.get(cells, label_at))
    merged_label = F.coalesce(label_cell["is_merged"], F.lit(False))
    label = F.when(label_cell.isNotNull() & ~merged_label, label_cell["raw_text"]).otherwise("")
    values = F.transform(
        "value_indexes", lambda i: F.coalesce(F.get(cells, i)["raw_text"], F.lit(""))
    )
    shown = F.transform(F.filter(cells, lambda c: ~c["is_merged"]), lambda c: c["raw_text"])
    some = lambda texts: F.exists(texts, lambda t: strip(t) != "")
    ruled = F.forall(shown, lambda t: (strip(t) == "") | T.is_separator_text(t)) & ~F.exists(
        shown, lambda t: t.rlike("[\\p{L}\\p{N}]")
    )
    laid = rows.withColumns({
        "label": label, "values": values, "shown": shown, "merged_label": merged_label,
    })
    kind = (
        F.when(~some(F.col("shown")), "empty")
        .when(ruled, "separator")
        .when(F.col("merged_label"), "continuation")
        .when((strip(F.col("label")) != "") & ~some(F.col("values")), "section_header")
        .otherwise("data")
    )
    return laid.select(
        "table_id", F.col("row").alias("row_index"), "label", "values",
        F.transform("cells", lambda c: c["raw_text"]).alias("cells_by_column"),
        kind.alias("kind"), T.indent_spaces(F.col("label")).alias("indent_spaces"),
        "label_column_index",
    )


def resolve_table_type(context: DataFrame) -> DataFrame:
    """Type of every table from its own heading, the page's hint, or the text around it.

    ``context`` has internal and surrounding headings (structs), the number of sections around, and
    section_hint.
    """
    internal, around, hint = F.col("internal"), F.col("surrounding"), F.col("section_hint")
    unclear = (F.col("sections_around") > 1) & internal.isNull() & hint.isNull()
    unclear = F.coalesce(unclear, F.lit(False))
    around_used = F.when(~unclear, around)
    differs = (hint != internal["section"]) | (around_used["section"] != internal["section"])
    hinted = F.struct(hint.alias("section"), hint.alias("matched_text"), F.lit(0.70).alias("confidence"))
    chosen = F.coalesce(internal, F.when(hint.isNotNull(), hinted), around_used)
    return context.withColumn("chosen", chosen).withColumns({
        "table_type": F.coalesce("chosen.section", F.lit("unknown")),
        "type_confidence": F.when(
            F.col("chosen.confidence").isNotNull(), F.least("chosen.confidence", F.lit(0.95))
        ),
        "type_matched_text": F.col("chosen.matched_text"),
        "type_warnings": F.array_compact(F.array(
            F.when(unclear, "ambiguous_section_context"),
            F.when(internal.isNotNull() & F.coalesce(differs, F.lit(False)), "conflicting_table_type"),
        )),
    }).drop("chosen")


def surrounding_context(page_texts: DataFrame) -> DataFrame:
    """What a page's text says about its tables, worked out once per page."""
    text = F.col("text")
    # The headings of a text are looked for once.
    found = page_texts.select("document_id", "page_number", "text", computed_once(text_headings(text)).alias("headings"))
    return found.select(
        "document_id", F.col("page_number").alias("page"),
        best_heading(text, headings=F.col("headings")).alias("surrounding"),
        F.size(distinct_sections(text, headings=F.col("headings"))).alias("sections_around"),
        T.unit_caption(text).alias("around_caption"), T.unit_scale(text).alias("around_scale"),
    )


def reconstruct_tables(
    cells: DataFrame, tables: DataFrame, page_texts: DataFrame | None = None,
    section_hints: DataFrame | None = None,
) -> Reconstruction:
    """Typed tables with columns and rows; the raw cells are never changed or dropped.

    ``tables`` has table_id, document_id, page, status and warnings.
    """
    spark = cells.sparkSession
    rows = table_rows(cells)
    band = stored(table_digests(row_flags(rows)), "table-digests")
    per_chunk = band.where("first_row IS NOT NULL").select(
        "table_id", "first_row", "band_size",
        F.explode(F.sequence(F.lit(0), F.col("last_chunk"))).alias("chunk"),
    )
    band_cells = band.where("first_row IS NOT NULL").select(
        "table_id", "first_row", "band_size", F.inline("band_rows")
    ).select("table_id", "row", "first_row", "band_size", F.inline("cells"))
    columns = build_columns(band_cells)
    picked = pick_label_column(columns)
    header = per_chunk.join(picked, "table_id").select(
        "table_id", "chunk", (F.col("first_row") + F.col("band_size")).alias("body_from"),
        "label_column_index", "value_indexes",
    )
    body = body_rows(
        rows.select("table_id", "chunk", "row", "cells").join(header, ["table_id", "chunk"])
        .where("row >= body_from")
    )
    has_data = body.groupBy("table_id").agg(F.bool_or(F.col("kind") == "data").alias("has_data"))

    if page_texts is None:
        page_texts = spark.createDataFrame([], "document_id bigint, page_number int, text string")
    if section_hints is None:
        section_hints = spark.createDataFrame([], "document_id bigint, page int, section_hint string")
    context = (
        tables.join(band.drop("band_rows"), "table_id", "left")
        .join(surrounding_context(page_texts), ["document_id", "page"], "left")
        .join(section_hints, ["document_id", "page"], "left")
        .join(picked, "table_id", "left")
        .join(has_data, "table_id", "left")
    )
    typed = resolve_table_type(context)
    unit = F.coalesce("cell_unit", "around_caption", "around_scale")
    empty_table, unknown = F.col("last_chunk").isNull(), F.col("table_type") == "unknown"
    no_data = F.col("first_row").isNotNull() & ~F.coalesce("has_data", F.lit(False))
    none = F.array().cast("array<string>")
    warnings = F.array_distinct(F.concat(
        F.col("warnings"), F.col("type_warnings"),
        F.coalesce("band_warnings", F.array(F.lit("no_header_or_body"))),
        F.array_compact(F.array(
            F.col("label_warning"),
            F.when(empty_table, "empty_raw_table"),
            F.when(unknown, "unknown_table_type"),
            F.when(unit.isNull(), "missing_unit_text"),
            F.when(no_data, "empty_body"),
        )),
    ))
    review = F.exists("all_warnings", lambda w: w.rlike("^(?:" + "|".join(V.REVIEW_WARNINGS) + ")(?::|$)"))
    not_ok = F.col("raw_status") != "OK"
    result = typed.withColumnRenamed("status", "raw_status").withColumns({
        "unit_text": unit, "all_warnings": warnings,
    })
    kept = [c for c in tables.columns if c not in ("warnings", "status")]
    result = result.select(
        *kept, "raw_status", "table_type", "unit_text", "type_confidence", "type_matched_text",
        F.when(
            review | not_ok | (~unknown & F.col("unit_text").isNull()), "NEEDS_REVIEW"
        ).otherwise("OK").alias("status"),
        F.array_distinct(F.concat(
            "all_warnings", F.when(not_ok, F.array(F.lit("raw_extraction_not_ok"))).otherwise(none)
        )).alias("warnings"),
        F.when(F.col("first_row").isNotNull(), F.sequence(
            F.col("first_row"), F.col("first_row") + F.col("band_size") - 1
        )).otherwise(F.array().cast("array<int>")).alias("header_band_row_indices"),
        "label_column_index",
    )
    return Reconstruction(result, columns, body)


def table_intermediate_json(
    result: Reconstruction, cells: DataFrame, rows_per_part: int = CHUNK_ROWS
) -> DataFrame:
    """The reconstructed table as JSON in parts: part 0 is the header with the columns, the others
    hold the rows and the raw cells of one stretch of rows each. No part grows with the table.
    """
    keep = {"ignoreNullFields": "false"}
    ordered = F.array_sort(F.collect_list(F.struct(
        "index", "header_text", "header_parts", "role", "span")))
    columns = result.columns.groupBy("table_id").agg(ordered.alias("columns"))
    head = result.tables.join(columns, "table_id", "left").select(
        "table_id", F.lit(0).alias("part"),
        F.to_json(F.struct(
            "table_type", "unit_text",
            F.struct("table_id", "page", "table_index", "document_id").alias("provenance"),
            "header_band_row_indices", "label_column_index",
            F.coalesce("columns", F.array().cast(columns.schema["columns"].dataType)).alias("columns"),
            F.struct("confidence", F.col("raw_status").alias("status"), T.bbox_list(F.col("bbox")).alias("bbox"),
                     "row_count", "column_count").alias("raw"),
        ), keep).alias("payload"),
    )
    part = lambda row: (F.floor(F.col(row) / rows_per_part) + 1).cast("int")
    row = F.struct(
        "row_index", "label", "values", "cells_by_column", "kind", "indent_spaces",
        (F.col("kind") == "section_header").alias("is_section_header"),
        (F.col("kind") == "continuation").alias("is_continuation"),
        (F.col("kind") == "separator").alias("is_separator"), "label_column_index",
    )
    rows = result.rows.groupBy("table_id", part("row_index").alias("part")).agg(
        F.array_sort(F.collect_list(row)).alias("rows")
    )
    cell = F.struct("row", "column", "raw_text", T.bbox_list(F.col("bbox")).alias("bbox"),
                    F.col("is_merged").alias("is_merged_continuation"))
    raw = cells.groupBy("table_id", part("row").alias("part")).agg(
        F.array_sort(F.collect_list(cell)).alias("cells")
    )
    body = raw.join(rows, ["table_id", "part"], "left").select(
        "table_id", "part",
        F.to_json(F.struct(
            F.coalesce("rows", F.array().cast(rows.schema["rows"].dataType)).alias("rows"), "cells"
        ), keep).alias("payload"),
    )
    return head.unionByName(body)
