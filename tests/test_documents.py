"""Headings, classes, OCR, bytes, cards and grids on literal input."""

import datetime as dt
import hashlib
import html
import io
import json
import os
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from quire import values as V
from quire.functions import tables as T
from quire.functions import text as X
from quire.operators import cells as C
from quire.operators import pages as P
from quire.operators import reconstruct as R
from quire.operators import sections as S
from quire.sources import binary, catalog, connectors, files, listing
from quire.streaming import streams


def test_folding_matches_the_exact_form(spark):
    chars = [chr(c) + "A" for c in range(1, 0x3000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in chars], "t string")
    wrong = df.where(X.fold_text(F.col("t")) != X.fold_text_exact("t")).collect()
    assert wrong == []
    assert X.fold_one("BẢNG CÂN ĐỐI_kế-toán.ß") == "bang can doi ke toan ss"


def test_section_hits_and_offsets(spark):
    text = "CÔNG TY\r\nBảng cân đối kế toán\n\x0bBáo cáo lưu chuyển tiền tệ\nBalance sheet\nThuyết minh\n"
    pages = spark.createDataFrame([(1, 1, text), (2, 1, "Mã số TÀI SẢN Thuyết minh 2025 VND\n")],
                                  "document_id int, page_number int, text string")
    hits = S.collect_section_hits(pages).orderBy("start_char").collect()
    assert [(h.document_id, h.section, h.matched_rule) for h in hits] == [
        (1, "balance_sheet", "vi_balance_sheet"), (1, "cash_flow_statement", "vi_cash_flow"),
        (1, "notes", "vi_notes_short_heading")]
    assert [text[h.start_char:].startswith(h.matched_text) for h in hits] == [True, True, True]
    lines = S.split_lines(pages.where("document_id = 1")).orderBy("line_no").collect()
    expected, offset = [], 0
    for line in text.splitlines(keepends=True):
        expected.append((offset, line.rstrip("\r\n")))
        offset += len(line)
    assert [(r.start_char, r.line) for r in lines] == expected


def test_class_order_and_metadata(spark):
    rows = [
        (1, "BCTC hợp nhất", None, "Thuyết minh báo cáo tài chính", {"type": "other"}),
        (2, "ANNUAL_REPORT-2025.pdf", None, None, {}), (3, "x", "y", "z", {"doc_type": " Periodic_Report "}),
        (4, "x", "y", "z", {"document_class": "nothing"}),
    ]
    docs = spark.createDataFrame(rows, "document_id int, title string, filename string, text_sample string, metadata map<string,string>")
    got = {r.document_id: (r.document_class, r.method, r.reason) for r in S.classify_documents(docs).collect()}
    assert got == {
        1: ("management_explanation", "pattern", "pattern_match"), 2: ("annual_report", "pattern", "pattern_match"),
        3: ("annual_report", "metadata", "metadata:doc_type"), 4: ("other", "pattern", "unmatched_needs_llm")}


def test_ocr_ladder(spark):
    rows = [
        (1, "x" * 50, None, None, False, "sufficient_native_text"), (2, "x" * 49, None, None, True, "image_coverage_unavailable"),
        (3, "", 0.0, "xref=1:no_rects", True, "image_coverage_incomplete"), (4, " \n", 0.049, None, False, "blank_page"),
        (5, "", 0.05, None, True, "image_only_page"), (6, "abc", 0.20, None, True, "low_text_high_image_coverage"),
        (7, "abc", 0.19, None, True, "insufficient_native_text"),
    ]
    pages = spark.createDataFrame([(1, n, t, c, 1, e) for n, t, c, e, _, _ in rows],
        "document_id int, page_number int, text string, image_coverage double, image_count int, image_coverage_error string")
    got = P.page_ocr_decision(pages).orderBy("page_number").collect()
    assert [(r.needs_ocr, r.reason) for r in got] == [(n, why) for *_, n, why in rows]


def test_ocr_quality(spark):
    scores = [(" ", 0.9), ("a", None), ("a", float("nan")), ("a", float("inf")), ("a", -0.1), ("a", 1.1), ("a", 0.59), ("a", 0.6)]
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(scores)], "i int, text string, confidence double")
    assert [r.quality_reason for r in P.ocr_quality(df).orderBy("i").collect()] == [
        "no_text_detected", "missing_confidence", *["invalid_confidence"] * 4, "low_confidence", "sufficient_confidence"]


def office_file(*names, text="x"):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for name in names:
            archive.writestr(name, text)
    return data.getvalue()


def test_file_types_and_files(spark, tmp_path):
    ole = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
    samples = {
        "b.pdf": (b" <HTML><p>", "unknown"), "c.txt": (b"%PDF-1.4", "PDF"), "d": (office_file("xl/workbook.xml"), "XLSX"),
        "e": (office_file("word/document.xml", text="see xl/workbook.xml"), "DOCX"), "f": (ole + b"x", "unknown"),
        "g": (office_file("xl/a", "word/b"), "unknown"), "h": (b"PK\x03\x04 xl/ no archive", "unknown"),
        "i": (ole + bytes(504) + b"\x09\x08\x10\x00\x00\x06\x05\x00 ", "XLS"), "with space.pdf": (b"", "unknown"),
        "j": (ole + bytes(504) + b"\xfd\xff\xff\xff\x00\x00\x02\x00\x00", "XLS"),
    }
    for name, (data, _) in samples.items():
        (tmp_path / name).write_bytes(data)
    found = binary.detect_file_type(binary.read_binary_corpus(spark, str(tmp_path)))
    got = {r.path.rsplit("/", 1)[1]: (r.file_type, r.size_bytes, r.sha256) for r in found.collect()}
    assert got == {name: (kind, len(data), hashlib.sha256(data).hexdigest()) for name, (data, kind) in samples.items()}


def test_entities_equal_the_standard_library(spark):
    texts = ["&eacute;&Agrave;", "&#150;&#0;&#x80;&#xD800;&#1114112;&#99999999999;", "&notit; &notin; &amp;lt; &nosuch; & &;",
             "&#65 &#x41z &#; &#x; &#11;&#9;", "<!-- -->&lt<!-- -->&frac12x &NotEqualTilde; &AMP", "no entity", "&#xFFFE;|&#127;|&#12;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", X.html_clean(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == [html.unescape(t.replace("<!-- -->", "")) for t in texts]


def test_numbers_read_as_python_writes_them(spark):
    numbers = [1e10, 1e-5, 1e16, 1e15, 0.1, 100.0, -2.5, 1e22, 5e-324, 123456.789, 0.0001]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n double")
    got = [r.t for r in df.select("i", X.value_text(F.col("n"), "double").alias("t")).orderBy("i").collect()]
    assert got == [str(n) for n in numbers]


def test_class_rules_stay_within_a_field(spark):
    rule = V.CLASS_RULES[0]
    rules = [rule._replace(pattern="^REPORT$", name="whole")]
    df = spark.createDataFrame([(1, "my", "report"), (2, "my report", "x"), (3, None, "Report")], "i int, a string, b string")
    got = {r.i: r.m for r in df.select("i", S.class_rule(F.col("a"), F.col("b"), rules=rules)["matched_pattern"].alias("m")).collect()}
    assert got == {1: "whole", 2: None, 3: "whole"}


def test_catalog_file(spark, tmp_path):
    (tmp_path / "c.json").write_text("""[{"ticker": "fpt", "source_document_id": "v1", "title": "Q1",
      "published_at": "2024-04-20T23:30:00-11:00", "attachments": [{"filename": "a.pdf", "download_reference": "r"}]}]""")
    row = catalog.read_disclosure_catalog(spark, str(tmp_path)).first()
    assert (row.ticker, row.document_type, row.is_correction, row.metadata) == ("FPT", "other", False, {})
    assert row.published_at.startswith("2024-04-20T23:30") and row.attachments[0].filename == "a.pdf"


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_json_files_in_ranges(spark, tmp_path, size):
    awkward = [{"a": '}{][\\" , \\\\'}, {"b": {"c": [1, {"d": '\\\\"'}]}}, {"e": "é ü 漢" * 9}, {}, {"f": ["[", "{", '"']}, {"g": "\\" * 7}]
    texts = {
        "array.json": json.dumps(awkward, ensure_ascii=False, indent=1), "escaped.json": json.dumps(awkward),
        "lines.json": "\n".join(json.dumps(x) for x in awkward), "deep/er/one.json": json.dumps(awkward[1]),
        "none.json": "[]", "empty.json": "", "odd.json": '[1, "x{", {"y": 2}, [{"z": 3}], null]', "_hidden.json": "{",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    listed = files.list_files(spark, str(tmp_path))
    assert {r.path.removeprefix(f"file:{tmp_path}/"): r.size_bytes for r in listed.collect()} == {
        n: len(t.encode()) for n, t in texts.items() if not n.startswith("_")}
    found = {}
    for r in files.json_elements(listed, size).orderBy("path", "start").collect():
        found.setdefault(r.path.removeprefix(f"file:{tmp_path}/"), []).append(json.loads(r.element))
    assert found == {"array.json": awkward, "escaped.json": awkward, "lines.json": awkward, "deep/er/one.json": [awkward[1]],
                     "odd.json": [{"y": 2}]}
    assert files.list_files(spark, str(tmp_path), "o*.json").count() == 2
    if size > 7:
        (tmp_path / "cut.json").write_text('[{"a": "')
        with pytest.raises(Exception, match="ends inside a value"):
            files.json_elements(files.list_files(spark, str(tmp_path)), size).collect()


def test_one_catalog_file_is_many_tasks(spark, tmp_path):
    rows = [{"ticker": "a", "source_document_id": f"d{i}", "title": "t" * 50} for i in range(400)]
    (tmp_path / "c.json").write_text(json.dumps(rows))
    cut = files.file_ranges(files.list_files(spark, str(tmp_path)), 4096)
    assert cut.count() > 5
    read = catalog.read_disclosure_catalog(spark, str(tmp_path), range_bytes=4096)
    assert sorted(r.source_document_id for r in read.collect()) == sorted(r["source_document_id"] for r in rows)


class Numbers:
    """A connector of its own: days of January, one publication each."""

    source = "OWN"

    def __init__(self, options):
        self.days = int(options["days"])

    def units(self):
        return [(f"{day:03d}", str(day)) for day in range(1, self.days + 1)]

    def read(self, unit):
        yield {"ticker": "xy"[int(unit) % 2], "source_document_id": f"n{unit}", "published_at": f"2031-01-{int(unit):02d}T00:00:00Z"}


def test_feeds_of_registered_connectors(spark, tmp_path):
    ids = lambda df: sorted(r.source_document_id for r in df.collect())
    own = {"connector": "tests.test_documents:Numbers", "days": "9"}
    feed = connectors.read_feed(spark, **own)
    assert len(ids(feed)) == 9 and {r.source for r in feed.collect()} == {"OWN"}
    assert ids(connectors.read_feed(spark, ticker="X", **own, **{"from": "2031-01-03", "to": "2031-01-06"})) == ["n4", "n6"]
    assert ids(connectors.read_feed(spark, document="n5", **own)) == ["n5"]
    # A stream reads what has been added since its checkpoint.
    folder, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))
    os.mkdir(folder)
    for step, expected in ((1, ["d1"]), (2, ["d1", "d2"])):
        with open(f"{folder}/f{step}.json", "w") as f:
            json.dump([{"ticker": "t", "source_document_id": f"d{step}"}], f)
        assert ids(streams.run_to_files(connectors.stream_feed(spark, path=folder).select("source_document_id"), out, progress)) == expected


def test_cards(spark):
    def card(title, date, *names):
        links = "".join(f'<a href="/api/download?url=https%3A%2F%2Fhost.test%2Fd%2F{n}.pdf">x</a>' for n in names)
        return f'<li><span class="q7">{title}</span><i>Updated<!-- -->: {date}</i>{links}</li>'
    page = "<ul>" + "".join([
        card("Press release", "1/1/2031", "press"),
        card("Information disclosures on the Q3 separate financial statement", "11/2/2031", "q3", "q3-en"),
        card("Audited consolidated financial statements, year 2030 &ndash; r&eacute;vis&eacute;", "3/9/2031", "fy30"),
        card("Information disclosure of a board decision", "12/31/2030", "board"),
        card("Information disclosure, no file", "1/1/2031"), card("Information disclosure, no day", "tomorrow", "y"),
    ]) + "</ul>"
    cards = listing.extract_disclosure_cards(spark.createDataFrame([(1, page)], "page_id int, html string"), "ABC", "abc-ir", "https://host.test")
    got = cards.orderBy("card_no").collect()
    assert [(c.scope, c.audit_status, [a.filename for a in c.attachments]) for c in got] == [
        ("standalone", "unknown", ["q3.pdf", "q3-en.pdf"]), ("consolidated", "audited", ["fy30.pdf"]),
        ("unknown", "unknown", ["board.pdf"])]
    assert [c.updated_date for c in got] == [dt.date(2031, 11, 2), dt.date(2031, 3, 9), dt.date(2030, 12, 31)]
    assert got[1].title == "Audited consolidated financial statements, year 2030 – révisé"
    assert got[2].source_document_id.endswith("-information-disclosure-of-a-board-decision-2030-12-31")


def test_overlap_against_all_pairs(spark):
    import random
    random.seed(7)
    def boxes(n):
        out = []
        for i in range(n):
            x, y, w, h = random.random() * 500, random.random() * 700, 5 + random.random() ** 3 * 400, 5 + random.random() ** 3 * 300
            out.append((f"t{i}", i % 2, 1, (x, y, x + w, y + h)))
        return out
    def frame(rows):
        return spark.createDataFrame([(t, d, p, b, ["partial_statement_region"] if t == "t3" else []) for t, d, p, b in rows],
            "table_id string, document_id int, page int, bbox struct<x0:double,y0:double,x1:double,y1:double>, warnings array<string>")
    native, raw = boxes(150), boxes(150)
    raw[10] = ("t10", 0, 1, native[4][3])
    def covered(a, b):
        w = max(0, min(a[2], b[2]) - max(a[0], b[0])); h = max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return w * h / min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1])) >= 0.8
    expected = {n[0] for n in native for r in raw if r[0] != "t3" and n[1] == r[1] and covered(n[3], r[3])}
    got = {r.table_id for r in C.overlap_replaces_native(frame(native), frame(raw)).collect()}
    assert got == expected and len(expected) > 5


def test_numbering_across_stretches(spark):
    n = 3 * C._STRETCH
    df = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("rank"), (F.col("id") * 5).alias("seq"))
    got = C.number_within(df, ["k"], "rank", "seq", "at").orderBy("rank", "seq").collect()
    assert [r["at"] for r in got] == list(range(n))


def test_small_files_are_dealt_by_number_and_size(spark, tmp_path):
    rows = [(f"{tmp_path}/n={i % 3}/{i}.html", f"trang {i}\n".encode()) for i in range(300)]
    files.write_files(spark.createDataFrame(rows, "path string, content binary"))
    listed = files.list_files(spark, str(tmp_path), "*.html")
    read = files.whole_texts(listed)
    # Spark's reader takes 32 files a task at most.
    assert read.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(r.text for r in read.collect()) == sorted(f"trang {i}\n" for i in range(300))
    assert listing.read_listing_pages(spark, str(tmp_path)).count() == 300


def test_file_ranges_are_not_left_to_one_task(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"ticker": "a", "title": "t" * 50} for _ in range(400)]))
    found = files.json_elements(files.list_files(spark, str(tmp_path)), 1024)
    assert found.rdd.getNumPartitions() >= min(2, spark.sparkContext.defaultParallelism)


def exchanges(df):
    df.count()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
            if "Exchange hashpartitioning" in line]


def test_matrices_are_built_where_the_cells_lie(spark):
    from workload.table_checks import matrices

    assert len(exchanges(matrices(spark, "/root/testdata/sf0.001"))) == 2


def test_sheet_slots_are_not_shuffled(spark):
    rows = [(1, 0, "S", 2, 2, "a", None, False, "B2"), (1, 0, "S", 2, 2, "b", None, False, "B2"), (1, 0, "S", 4, 4, None, "=x", True, "D4"),
            (1, 0, "S", 3, 3, None, None, True, "C3"), (1, 0, "S", 9, 9, None, None, False, "I9"), (1, 0, "S", 2, 9, None, None, False, "I2"),
            (1, 1, "T", 1, 1, None, None, False, "A1")]
    cells = spark.createDataFrame(rows, "document_id long, sheet_index int, sheet_name string, row int, column int, value_text string, "
                                        "formula_text string, is_merged boolean, address string")
    grid = C.sheet_to_grid(cells)
    assert not [line for line in exchanges(grid) if "column" in line]
    found = sorted((r.row, r.column, r.raw_text, r.is_merged, r.warning) for r in grid.collect())
    shown = {(0, 0): ["a", "b"], (2, 2): ["=x"]}
    wanted = [(r, c, t, (r, c) == (1, 1), "merged_continuation:C3" if (r, c) == (1, 1) else None)
              for r in range(3) for c in range(3) for t in shown.get((r, c), [""])]
    assert found == sorted(wanted, key=lambda x: x[:3])
    assert C.sheet_to_grid(cells, texts=False).count() == len(wanted)


def test_artifacts_are_shuffled_by_digest_once(spark):
    from quire.operators import ingest as I

    artifacts = spark.createDataFrame(
        [("a", 1, "s", "x.pdf", None, 3), ("b", 2, "s", "y.pdf", None, 5), ("c", 9, "s", "z.pdf", None, 7), ("d", 1, "t", "t.pdf", None, 1),
         ("e", 1, "u", "u.txt", "application/pdf", 1), ("f", 1, "s", "n.txt", None, 9)],
        "id string, publication_id long, sha256 string, filename string, mime_type string, n int").withColumn(
        "created_at", F.timestamp_seconds("n")).drop("n")
    objects = spark.createDataFrame([("s", 2000), ("t", 1000), ("u", 1001)], "sha256 string, size_bytes long")
    publications = spark.createDataFrame([(1, "one"), (2, "two")], "id long, title string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = I.artifact_export_candidates(artifacts, objects, publications)
        assert len([line for line in exchanges(found) if "sha256" in line.split("hashpartitioning")[1][:12]]) == 2
        assert sorted((r.sha256, r.id, r.publication_title, r.size_bytes) for r in found.collect()) == [
            ("s", "b", "two", 2000), ("u", "e", "one", 1001)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cells_of_some_documents(spark):
    from workload import views as v

    folder = "/root/testdata/sf0.001"
    some = spark.createDataFrame([(2,), (5,), (5,), (10**9,)], "document_id long")
    cells = v.v_cell(spark, folder)
    wanted = cells.where("document_id IN (2, 5)")
    found = v.v_cell(spark, folder, some)
    assert found.count() == wanted.count() > 0 and found.exceptAll(wanted).isEmpty()


def test_words_that_a_match_needs():
    patterns = [r.pattern for r in V.HEADING_RULES] + [V.UNIT_CAPTION, V.UNIT_SCALE, "ab?c{2}|(?:de|f*)gh", "a(?!b)cd", "x+|yy"]
    texts = ["CASH_FLOW STATEMENT", "P & L", "Units: VND", "in  Millions of x", "ACC", "fgh", "gh", "acd", "YY", "thuyet minh", "trieu dong", "bao cao lai-lo"]
    for pattern in patterns:
        words = X.needed_words(pattern)
        assert words is not None
        for text in texts:
            assert not re.search(pattern, text, re.I) or any(w in text.lower() for w in words), (pattern, text)
    for pattern in ("a|", "[a[bc]]d", "(?x)a b", "\\p{L}ab", "\\Qab\\E", "(a", "[^x]", "\u0131"):
        assert X.needed_words(pattern) is None
    assert X.needed_words("\u0111vt") == ()


def test_headings_are_those_of_all_patterns(spark):
    """A line is a heading whether or not it has letters beyond ASCII, also such as only case-blind patterns take for ASCII."""
    rules = sorted(V.HEADING_RULES, key=lambda rule: -rule.priority)
    lines = ["BALANCE SHEET", "  income_statement ", "\u0131ncome statement", "B\u1ea3ng c\u00e2n \u0111\u1ed1i k\u1ebf to\u00e1n", "P & L", "p&l",
             "ordinary", "", None, "a statement", "Thuy\u1ebft minh", "notes to financial \u017ftatements", "\ud55c balance sheet"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    plain = X.first_matching(lambda pattern: F.col("f").rlike(pattern), rules, lambda rule: F.lit(rule.name))
    got = df.withColumn("f", X.fold_text(X.strip(F.col("t")))).select(
        "t", S.heading_rule(F.col("t"))["matched_rule"].alias("got"), plain.alias("plain")).collect()
    assert all(r.got == r.plain for r in got) and sum(r.got is not None for r in got) == 9
    units = ["Unit: VND", "\u0111\u01a1n v\u1ecb: \u0111\u1ed3ng", "IN MILLIONS OF x", "3 m\u0131ll\u0131on vnd", "tri\u1ec7u \u0111\u1ed3ng", "none", None, ""]
    df = spark.createDataFrame([(t,) for t in units], "t string")
    for r in df.select("t", T.has_unit(F.col("t")).alias("has"), T.unit_caption(F.col("t")).alias("c"), T.unit_scale(F.col("t")).alias("s"),
                       F.regexp_extract("t", f"(?isU){V.UNIT_CAPTION}", 1).alias("c0"), F.regexp_extract("t", f"(?iU){V.UNIT_SCALE}", 1).alias("s0")).collect():
        assert (r.c or "", r.s or "") == (r.c0 or "", r.s0 or "") and r.has == (None if r.t is None else bool(r.c0 or r.s0))


def test_a_text_is_parted_into_lines_once(spark, capsys):
    texts = ["a\r\nb\n\nc", "\n", "x", "", None, "a\x1db\x85\u2028c\r", "\r\n\r"]
    pages = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "document_id bigint, page_number int, text string")
    got = {r.page_number: r.x for r in pages.select("page_number", S.lines_with_breaks(F.col("text")).alias("x")).collect()}
    assert got == {i: None if t is None else t.splitlines(keepends=True) for i, t in enumerate(texts)}
    for df in (R.surrounding_context(pages), S.collect_section_hits(pages)):
        df.explain()
        plan = capsys.readouterr().out
        assert len(re.findall(r"regexp_extract_all\(text#", plan)) == 1, plan
