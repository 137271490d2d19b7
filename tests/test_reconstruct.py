"""Literal tables with their exact reconstruction, all rebuilt in one job."""

import pytest
from pyspark.sql import functions as F

from quire.operators import reconstruct as R

SPANNED = ("", True)


def quay(i):
    """A body row of the quay table: name, place, and three amounts in as many notations."""
    return [f"Quay {i}", str(i), f"{i * 1375},{i}", f"-{i * 220}", f"({i}.{i:03})"]


# name: (rows, text around the table, section hint)
TABLES = {
    # Title and unit above one header row; seven body rows by rule.
    "quays": ([["Cash-flow statement of the harbour board", *[SPANNED] * 4], ["Đvt: tỷ đồng", *[SPANNED] * 4],
               ["Nội dung", "STT", "Q1", "Q2", "Year to date"], *[quay(i) for i in range(1, 8)]], None, None),
    # Three header rows, nested spans, the label in the second column, code first; all else from around the table.
    "nested": ([["", "", "Inbound", SPANNED, SPANNED, "Outbound"], ["", "", "Dry", SPANNED, "Wet", "Dry"],
                ["Codes", "Description", "2031", "2030", "2031", "2031"],
                ["B7", "Barges moored", "12,450", "11,980", "3.075", "-18"]],
               "Báo cáo lãi lỗ\nUnits of measure: tonnes\n", None),
    # Only a hint tells the type; no unit anywhere.
    "hinted": ([["No.", "Assets", "Notes", "31-12-2031"], ["1", "Cranes", "4.a", "98 765"]], None, "balance_sheet"),
    # No header names the label.
    "guessed": ([["Harbour", "Master", "2029"], ["Eastgate", "Oda", "41,006"]], "In thousands of crowns\n", "income_statement"),
    # Each kind of body row.
    "kinds": ([["Description", "Q1", "Q2"], ["DRY CARGO", "", ""], ["    Grain", "5,500", "7,250"], ["====", "----", "...."],
               [SPANNED, "60,000", "1,000"], [SPANNED, "", SPANNED], ["Timber\nand\nplanks", SPANNED, "8,800"]],
              "Unit - wagons", "income_statement"),
    # The table's own title beats the hint; two sections around it and no hint leave the type open.
    "contrary": ([["Balance sheet", SPANNED], ["Items", "2029"], ["Lighthouse", "70,011"], ["Buoys", "1,204"]], None, "cash_flow_statement"),
    "torn": ([["Items", "2029"], ["Lighthouse", "70,011"]], "Balance sheet\nIncome statement\n", None),
    "blank": ([], None, None),
    # More than two chunks long: a caption lies across a border of chunks, the title in the last row.
    "long": ([["Items", "2029", "2028"], *[[f"Berth {i}", str(5000 + 3 * i), str(4000 + i)] for i in range(2 * R.CHUNK_ROWS - 2)],
              ["Units", "", ""], ["of measure: berths", "", ""], ["Báo cáo tình hình tài chính", "", ""]], None, None),
}


@pytest.fixture(scope="module")
def rebuilt(spark):
    cells, tables, texts, hints = [], [], [], []
    for n, (name, (rows, around, hint)) in enumerate(TABLES.items()):
        review = name == "blank"
        tables.append((name, n, 1, "NEEDS_REVIEW" if review else "OK", ["empty_grid"] if review else []))
        if around:
            texts.append((n, 1, around))
        if hint:
            hints.append((n, 1, hint))
        for r, row in enumerate(rows):
            for c, cell in enumerate(row):
                text, merged = cell if isinstance(cell, tuple) else (cell, False)
                cells.append((name, r, c, text, merged))
    result = R.reconstruct_tables(
        spark.createDataFrame(cells, "table_id string, row int, column int, raw_text string, is_merged boolean"),
        spark.createDataFrame(tables, "table_id string, document_id bigint, page int, status string, warnings array<string>"),
        spark.createDataFrame(texts, "document_id bigint, page_number int, text string"),
        spark.createDataFrame(hints, "document_id bigint, page int, section_hint string"),
    )
    tables = {r.table_id: r for r in result.tables.collect()}
    columns, rows = {}, {}
    for r in result.columns.orderBy("index").collect():
        columns.setdefault(r.table_id, []).append(r)
    for r in result.rows.where(F.col("table_id") != "long").orderBy("row_index").collect():
        rows.setdefault(r.table_id, []).append(r)
    return tables, columns, rows


@pytest.mark.parametrize(("name", "table_type", "unit", "status", "band", "label"), [
    ("quays", "cash_flow_statement", "Đvt: tỷ đồng", "OK", [2], 0),
    ("nested", "income_statement", "Units of measure: tonnes", "OK", [0, 1, 2], 1),
    # A known type without a unit is looked at.
    ("hinted", "balance_sheet", None, "NEEDS_REVIEW", [0], 1),
    ("guessed", "income_statement", "In thousands of crowns", "NEEDS_REVIEW", [0], 0),
    ("kinds", "income_statement", "Unit - wagons", "OK", [0], 0),
    ("contrary", "balance_sheet", None, "NEEDS_REVIEW", [1], 0),
    ("torn", "unknown", None, "NEEDS_REVIEW", [0], 0),
    ("blank", "unknown", None, "NEEDS_REVIEW", [], None),
    ("long", "balance_sheet", "Units of measure: berths", "OK", [0], 0),
])
def test_tables(rebuilt, name, table_type, unit, status, band, label):
    t = rebuilt[0][name]
    assert (t.table_type, t.unit_text, t.status) == (table_type, unit, status), t
    assert (t.header_band_row_indices, t.label_column_index) == (band, label)
    assert t.type_confidence is None or t.type_confidence <= 0.95


def test_warnings(rebuilt):
    tables = rebuilt[0]
    assert tables["hinted"].warnings == ["missing_unit_text"]
    assert "ambiguous_label_column" in tables["guessed"].warnings and "conflicting_table_type" in tables["contrary"].warnings
    assert {"ambiguous_section_context", "unknown_table_type", "missing_unit_text"} <= set(tables["torn"].warnings)
    assert {"empty_grid", "no_header_or_body", "empty_raw_table", "raw_extraction_not_ok"} <= set(tables["blank"].warnings)
    assert not tables["quays"].warnings and not tables["nested"].warnings


def test_columns(rebuilt):
    columns = rebuilt[1]
    assert [c.role for c in columns["quays"]] == ["label", "index", "value", "value", "value"]
    assert [c.role for c in columns["hinted"]] == ["index", "label", "note", "value"]
    nested = columns["nested"]
    assert [c.header_text for c in nested] == [
        "Codes", "Description", "Inbound | Dry | 2031", "Inbound | Dry | 2030", "Inbound | Wet | 2031", "Outbound | Dry | 2031"]
    assert nested[4].header_parts == ["Inbound", "Wet", "2031"] and [c.role for c in nested[:2]] == ["code", "label"]
    assert [c.span for c in columns["quays"]] == [1] * 5 and nested[2].span == 3


def test_rows(rebuilt):
    rows = rebuilt[2]
    assert [(r.label, r["values"]) for r in rows["quays"]] == [(quay(i)[0], quay(i)[2:]) for i in range(1, 8)]
    assert [(r.label, r["values"], r.cells_by_column) for r in rows["nested"]] == [
        ("Barges moored", ["12,450", "11,980", "3.075", "-18"], ["B7", "Barges moored", "12,450", "11,980", "3.075", "-18"])]
    kinds = rows["kinds"]
    assert [r.kind for r in kinds] == ["section_header", "data", "separator", "continuation", "empty", "data"]
    assert (kinds[1].label, kinds[1].indent_spaces) == ("    Grain", 4) and kinds[5].label == "Timber\nand\nplanks"


def test_band_whose_first_row_is_data_and_starts_in_a_later_chunk(spark):
    """The band comes from the digests of the chunks, in one pass, also with cells that no header row has."""
    n = R.CHUNK_ROWS
    rows = [["", ""]] * (n - 1) + [["Lamp", "70,011"], ["Items", "2029"], ["Buoys", "1,204"]]
    cells = spark.createDataFrame(
        [("t", r, c, text, False) for r, row in enumerate(rows) for c, text in enumerate(row)],
        "table_id string, row int, column int, raw_text string, is_merged boolean")
    digest = R.table_digests(R.row_flags(R.table_rows(cells))).first()
    assert (digest.first_row, digest.band_size, digest.band_warnings) == (n - 1, 2, [])
    assert [(b.row, [c.raw_text for c in b.cells]) for b in digest.band_rows] == [
        (n - 1, ["Lamp", "70,011"]), (n, ["Items", "2029"])]
    assert digest.cell_unit is None and digest.internal is None
