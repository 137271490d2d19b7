
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.tables import BBOX

HEADINGS = (
    "BẢNG CÂN ĐỐI KẾ TOÁN\n",
    "Income statement\n",
    "THUYẾT MINH\n",
    "Đơn vị: triệu đồng\n",
    "Thuyết minh báo cáo tài chính hợp nhất\n",
    "  Cash-flow statement for 2024\n",
    "Báo cáo lưu chuyển tiền tệ\nBalance sheet\n",
    "",
)
TITLES = (
    "BCTC hợp nhất 2024", "Annual_report-2024", "Nghị quyết HĐQT", "Đại hội cổ đông thường niên",
    "Công bố thông tin bất thường", "", "Giải trình kết quả",
)
# Header rows of the four table variants: (variant, row, column, text, merged continuation).
HEADER_CELLS = [
    (variant, row, column, *(("", True) if text is None else (text, False)))
    for variant, rows in enumerate(
        (
            (("Chỉ tiêu", "Mã số", "Thuyết minh", "Năm nay", "Năm trước"),),
            (
                ("Bảng cân đối kế toán", None, None, None, None),
                ("Đơn vị: triệu đồng", None, None, None, None),
                ("ASSETS", "Codes", "Notes", "30/06/2026", "31/12/2025"),
            ),
            (
                ("", "", "", "Current period", None),
                ("Items", "Code", "Notes", "2026", "2025"),
            ),
            (("No.", "Number", "Alpha", "Beta", "Gamma"),),
        )
    )
    for row, cells in enumerate(rows)
    for column, text in enumerate(cells)
]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pick(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def v_pub(spark: SparkSession, d: str) -> DataFrame:
    """Publications from orders; see `sql_views.V_PUB` for the same definition in SQL."""
    orders = table(spark, d, "orders")
    by_customer = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    key = F.col("o_orderkey")
    supersedes = (
        F.when(key % 5 == 0, F.lit(None).cast("bigint"))
        .when(key % 23 == 0, F.lit(-1).cast("bigint"))
        .when(key % 7 == 0, F.lag("o_orderkey", 2).over(by_customer))
        .otherwise(F.lag("o_orderkey", 1).over(by_customer))
    )
    return orders.select(
        key.alias("id"),
        F.col("o_custkey").alias("company_id"),
        F.concat(F.lit("SRC"), (F.col("o_custkey") % 3).cast("string")).alias("source"),
        F.concat(F.lit("ord-"), key.cast("string")).alias("source_document_id"),
        pick(
            key % 5,
            ("periodic_report", "financial_statement", "event_disclosure", "material_disclosure",
             "other"),
        ).alias("document_type"),
        F.col("o_orderpriority").alias("title"),
        F.when(key % 17 != 0, F.col("o_orderdate")).alias("published_at"),
        F.when(key % 17 == 0, F.to_date("o_orderdate")).alias("source_updated_date"),
        F.when(key % 17 == 0, F.lit("DATE")).alias("published_at_precision"),
        pick(key % 4, ("consolidated", "parent", "standalone", "unknown")).alias("scope"),
        pick(key % 3, ("audited", "unaudited", "unknown")).alias("audit_status"),
        F.when(key % 2 == 0, F.lit("vi")).alias("language"),
        F.concat(F.lit("ref/"), key.cast("string")).alias("source_reference"),
        F.when(supersedes.isNotNull(), F.concat(F.lit("ord-"), supersedes.cast("string"))).alias(
            "supersedes"
        ),
        (key % 3 == 0).alias("is_correction"),
        F.col("o_orderdate").alias("updated_at"),
    )


def v_art(spark: SparkSession, d: str) -> DataFrame:
    """Attachments from lineitem; the natural key (publication, reference) repeats."""
    part = F.col("l_partkey")
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("publication_id"),
        F.concat(F.lit("att-"), F.col("l_linenumber").cast("string")).alias("attachment_reference"),
        F.concat(F.lit("file-"), part.cast("string"),
                 pick(part % 3, (".pdf", ".PDF", ".xlsx"))).alias("filename"),
        F.when(part % 4 == 0, "application/pdf").otherwise("application/octet-stream").alias(
            "mime_type"
        ),
        (F.col("l_quantity") * 100).cast("bigint").alias("file_size"),
        F.sha2(part.cast("string"), 256).alias("sha256"),
        F.col("l_shipdate").alias("created_at"),
    )


def v_page(spark: SparkSession, d: str) -> DataFrame:
    """Pages of four lines each from documents, with every OCR outcome present."""
    doc = F.col("doc_id")
    pages = table(spark, d, "documents").select(
        doc, "lang",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(F.split("text", "\n")) - 1) / 4).cast("int")),
                lambda p: F.struct(
                    (p + 1).alias("page_number"),
                    F.array_join(F.slice(F.split("text", "\n"), p * 4 + 1, 4), "\n").alias("text"),
                ),
            )
        ).alias("p"),
    ).select("doc_id", "lang", "p.*")
    h = (doc * 7 + F.col("page_number")) % 9
    odd = (doc + F.col("page_number")) % 2
    text = F.when(h == 0, "").when(h == 1, F.substring("text", 1, 20)).otherwise(F.col("text"))
    return pages.select(
        doc.alias("document_id"),
        "page_number",
        "lang",
        text.alias("text"),
        F.lit(595.0).alias("width"),
        F.lit(842.0).alias("height"),
        F.when(doc % 11 != 0, (doc % 10).cast("double") / 20.0 * odd).alias("image_coverage"),
        odd.cast("int").alias("image_count"),
        F.when(doc % 13 == 0, "xref=1:no_rects").alias("image_coverage_error"),
    )


def v_head(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a statement heading in front, and the fields a classifier reads."""
    doc = F.col("doc_id")
    return table(spark, d, "documents").select(
        doc.alias("document_id"),
        (doc % 5 + 1).cast("int").alias("page_number"),
        F.concat(pick(doc % 8, HEADINGS), F.col("text")).alias("text"),
        pick(doc % 7, TITLES).alias("title"),
        F.concat(F.lit("file_"), doc.cast("string"),
                 F.when(doc % 6 == 0, "_bctc.pdf").otherwise(".pdf")).alias("filename"),
        F.when(doc % 4 == 0, "periodic_report").when(doc % 4 == 1, "event_disclosure")
        .when(doc % 4 == 2, " Other ").alias("document_type"),
        "lang",
        F.col("source").alias("origin"),
    )


def v_line(spark: SparkSession, d: str, documents: DataFrame | None = None) -> DataFrame:
    """One line item per (order, line), numbered densely within its order; of the orders of ``documents``, if given."""
    values = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag", "l_linestatus"]
    # One shuffle by order and one sort serve both: the first of equal lines, and the numbers of lines.
    lines = of_documents(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *values), documents)
    lines = lines.repartition("l_orderkey")
    same = W.partitionBy("l_orderkey", "l_linenumber").orderBy(*values)
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber")
    return lines.withColumn("n", F.row_number().over(same)).where("n = 1").select(
        "l_orderkey", "l_linenumber", *values,
        (F.row_number().over(order) - 1
         + pick(F.col("l_orderkey") % 4, (1, 3, 2, 1))).alias("row"),
    )


def of_documents(lines: DataFrame, documents: DataFrame | None) -> DataFrame:
    """Lines whose order lies in one of the documents: whole orders, as a document has ten."""
    if documents is None:
        return lines
    document = F.floor(lines["l_orderkey"] / 10).cast("bigint")
    return lines.join(documents, document == documents["document_id"], "left_semi")


def v_table(spark: SparkSession, d: str) -> DataFrame:
    """Header of every table: one table per order, ten orders per document, three per page."""
    return with_table_keys(table(spark, d, "lineitem").select("l_orderkey").distinct()).select(
        "table_id", "document_id", "page", "table_index"
    )


def with_table_keys(df: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    within = key % 10
    return df.withColumns({
        "table_id": F.concat(F.lit("T"), key.cast("string")),
        "document_id": F.floor(key / 10).cast("bigint"),
        "page": (F.floor(within / 3) + 1).cast("int"),
        "table_index": (within % 3).cast("int"),
    })


def v_cell(spark: SparkSession, d: str, documents: DataFrame | None = None) -> DataFrame:
    """Cells of every table, or of the tables of ``documents``: header variant by order, then one row per line item."""
    return keyed_cells(spark, d, documents).drop("l_orderkey")


def keyed_cells(spark: SparkSession, d: str, documents: DataFrame | None = None) -> DataFrame:
    """The cells with the order of their table. They lie by that key, so what is grouped by it needs no further shuffle."""
    part = F.col("l_partkey")
    label = F.concat(
        F.when(part % 5 == 0, "  ").otherwise(""), F.col("l_returnflag"), F.lit(" "), "l_linestatus"
    )
    separator, section, blank = part % 37 == 0, part % 31 == 0, F.lit("")
    texts = F.array(
        F.when(separator, "---").when(part % 41 == 0, blank).otherwise(label),
        F.when(separator, "---").otherwise((part % 1000).cast("string")),
        F.when(separator, "---").otherwise(blank),
        F.when(separator, "---").when(section, blank)
        .otherwise(F.floor("l_extendedprice").cast("bigint").cast("string")),
        F.when(separator, "---").when(section, blank)
        .otherwise(F.concat(F.lit("("), (F.col("l_suppkey") * 1000).cast("string"), F.lit(")"))),
    )
    body = (
        v_line(spark, d, documents)
        .select(
            "l_orderkey", "row", part, "l_suppkey",
            F.posexplode(texts).alias("column", "raw_text"),
        )
        .where(~((F.col("column") == 4) & (F.col("l_suppkey") % 19 == 0)))
        .select(
            "l_orderkey", "row", "column", "raw_text",
            ((F.col("column") == 0) & (part % 41 == 0) & (part % 37 != 0)
             | (F.col("column") == 2) & (part % 13 == 0) & (part % 37 != 0)).alias("is_merged"),
            (part % 29 == 0).alias("no_box"),
        )
    )
    heads = F.broadcast(
        spark.createDataFrame(
            HEADER_CELLS, "variant int, row int, column int, raw_text string, is_merged boolean"
        )
    )
    orders = of_documents(table(spark, d, "lineitem").select("l_orderkey"), documents).distinct()
    header = orders.join(heads, orders["l_orderkey"] % 4 == heads["variant"]).select(
        "l_orderkey", "row", "column", "raw_text", "is_merged", F.lit(False).alias("no_box")
    )
    cells = with_table_keys(header.unionByName(body))
    x0, y0 = F.col("column") * 100.0 + 50.0, F.col("row") * 20.0 + 100.0
    box = F.struct(x0.alias("x0"), y0.alias("y0"), (x0 + 100.0).alias("x1"),
                   (y0 + 20.0).alias("y1")).cast(BBOX)
    return cells.select(
        "l_orderkey", "table_id", "document_id", "page", "table_index", "row", "column", "raw_text", "is_merged",
        F.when(~F.col("no_box") & ~F.col("is_merged"), box).alias("bbox"),
    )


def v_card(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages: the raw page followed by one disclosure card per link."""
    page = F.col("page_id")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    cards = F.array_join(
        F.transform(
            links,
            lambda link, i: F.concat(
                F.lit('<div><span class="t"> '),
                F.when(i == 0, "Information disclosure ")
                .when(i == 1, "Audited consolidated financial statements ")
                .otherwise("information disclosures unaudited separate financial statement "),
                title,
                F.lit("</span><span>Updated<!-- -->: <!-- -->"),
                F.when(i == 2, "soon").otherwise(
                    F.concat((page % 12 + 1).cast("string"), F.lit("/"),
                             (page % 28 + 1).cast("string"), F.lit("/2024"))
                ),
                F.lit('</span><a href="/api/download?url=https%3A%2F%2Fexample.com'),
                F.replace(link, F.lit("/"), F.lit("%2F")),
                F.lit('.pdf">Download</a></div>'),
            ),
        ),
        "\n",
    )
    return table(spark, d, "pages").select(
        "page_id", F.concat(F.col("html"), cards).alias("html")
    )


JOB_STATUS = {
    "view": "PENDING", "click": "PROCESSING", "purchase": "PROCESSED", "signup": "NEEDS_REVIEW",
    "error": "FAILED",
}


def v_job(spark: SparkSession, d: str) -> DataFrame:
    """Job events: one event per row, the user is the artifact."""
    status = F.lit(None).cast("string")
    for event, mapped in JOB_STATUS.items():
        status = F.when(F.col("event_type") == event, mapped).otherwise(status)
    return table(spark, d, "events").select(
        F.col("event_id").alias("event_id"),
        F.col("user_id").alias("artifact_id"),
        status.alias("status"),
        "ts",
        F.when(F.col("event_id") % 3 == 0, F.lit("native")).alias("parser"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("boom "), F.col("event_id"))).alias(
            "error"
        ),
        "value",
    )
