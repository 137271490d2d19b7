"""Functions on table cells, headers, boxes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import values as V
from quire.functions.text import DIGIT, bind, collapse_blanks, extracted, fold_text, may_match, strip

BBOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def has_digit(text: Column) -> Column:
    return text.rlike(DIGIT)


def bare_is_period(text: Column) -> Column:
    """`is_period_token` of a text without blanks around it."""
    either = "|".join(f"(?:{pattern})" for pattern in V.PERIOD_TOKENS)
    # Each token is a whole text; said once in front, no other place is tried.
    start = "^" if all(pattern.startswith("^") for pattern in V.PERIOD_TOKENS) else ""
    return text.rlike(f"(?iU){start}(?:{either})")


def is_period_token(text: Column) -> Column:
    """A year, a date or a period word, alone in its cell."""
    return bare_is_period(strip(text))


def bare_is_small_number(text: Column) -> Column:
    return text.rlike("^\\p{Nd}{1,3}$")


def is_small_number(text: Column) -> Column:
    return bare_is_small_number(strip(text))


def is_amount(text: Column) -> Column:
    """A figure that is neither a period nor a bare number of one to three digits."""
    return has_digit(text) & ~is_small_number(text) & ~is_period_token(text)


def has_unit(text: Column) -> Column:
    either = text.rlike(f"(?isU){V.UNIT_CAPTION}") | text.rlike(f"(?iU){V.UNIT_SCALE}")
    return may_match(text, V.UNIT_CAPTION, V.UNIT_SCALE) & either


def unit_caption(blob: Column) -> Column:
    """First unit caption, blanks collapsed; null if there is none or it is too long."""
    found = extracted(blob, V.UNIT_CAPTION, "isU")
    fits = lambda text: F.when(F.length(text).between(1, V.MAX_UNIT_CHARS), text)
    return F.when(found != "", bind(collapse_blanks(found), fits))


def unit_scale(blob: Column) -> Column:
    return F.nullif(strip(extracted(blob, V.UNIT_SCALE, "iU")), F.lit(""))


def extract_unit_text(*blobs: Column) -> Column:
    """Caption before scale within a text; an earlier text wins over a later one."""
    return F.coalesce(*(found for blob in blobs for found in (unit_caption(blob), unit_scale(blob))))


def column_role(header: Column) -> Column:
    def ladder(folded: Column) -> Column:
        result = F.when(folded == "", "value")
        for role, pattern in V.HEADER_ROLES:
            result = result.when(folded.rlike(f"(?U){pattern}"), role)
        return result.otherwise("value")

    return bind(fold_text(header), ladder)


def indent_spaces(label: Column) -> Column:
    return F.length(label) - F.length(F.ltrim(label, F.lit(" \t")))


def is_separator_text(text: Column) -> Column:
    return text.rlike(f"(?U){V.SEPARATOR_CELL}")


def matrix_cell_bbox(
    box: Column, row: Column, column: Column, row_count: Column, column_count: Column
) -> Column:
    """Equal share of the table box for one cell of a matrix."""
    width = (box["x1"] - box["x0"]) / column_count
    height = (box["y1"] - box["y0"]) / row_count
    cell = F.struct(
        (box["x0"] + column * width).alias("x0"),
        (box["y0"] + row * height).alias("y0"),
        (box["x0"] + (column + 1) * width).alias("x1"),
        (box["y0"] + (row + 1) * height).alias("y1"),
    )
    return F.when(box.isNotNull() & (row_count > 0) & (column_count > 0), cell)


def make_table_id(
    page: Column,
    table_index: Column,
    document_id: Column | None = None,
    artifact_id: Column | None = None,
    source_sha256: Column | None = None,
    source_label: Column | None = None,
    sidecar: bool = False,
) -> Column:
    """Identity of a table: the most specific known key of its document, page and position."""
    ids = [c.cast("string") for c in (document_id, artifact_id) if c is not None]
    texts = [F.nullif(c, F.lit("")) for c in (source_sha256, source_label) if c is not None]
    if sidecar:
        texts = texts[:1]
    key = F.coalesce(*ids, *texts, F.lit("unknown-doc"))
    middle = ":raw:t" if sidecar else ":t"
    return F.concat(key, F.lit(":p"), page.cast("string"), F.lit(middle), table_index.cast("string"))


def bbox_list(box: Column) -> Column:
    return F.when(box.isNotNull(), F.array(box["x0"], box["y0"], box["x1"], box["y1"]))


def block_structure(block_type: Column, box: Column, content: Column) -> Column:
    """``{"type", "bbox", "content"}`` as JSON; a missing box is an empty list."""
    empty = F.array().cast("array<double>")
    return F.to_json(
        F.struct(
            block_type.alias("type"),
            F.coalesce(bbox_list(box), empty).alias("bbox"),
            content.alias("content"),
        ),
        {"ignoreNullFields": "false"},
    )


def poly_to_bbox(poly: Column) -> Column:
    """Bounding box of a polygon; one bad point makes the whole box null."""
    bad = F.exists(
        poly,
        lambda p: p.isNull() | (F.size(p) < 2) | F.get(p, F.lit(0)).isNull() | F.get(p, F.lit(1)).isNull(),
    )
    xs = F.transform(poly, lambda p: F.get(p, F.lit(0)))
    ys = F.transform(poly, lambda p: F.get(p, F.lit(1)))
    box = F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )
    return F.when(poly.isNotNull() & (F.size(poly) > 0) & ~bad, box)
