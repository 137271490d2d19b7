"""Listing pages of an issuer: disclosure cards in HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import values as V
from quire.functions import text as X
from quire.sources.files import list_files, whole_texts

_MARK = "\x01"


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files under a path, one row per page."""
    return whole_texts(list_files(spark, path)).withColumnsRenamed({"path": "page_id", "text": "html"})


def extract_disclosure_cards(
    pages: DataFrame, ticker: str, id_prefix: str, host: str, title_pattern: str = V.TITLE_SPAN,
    link_pattern: str = V.DOWNLOAD_LINK, bare_names: bool = True,
) -> DataFrame:
    """One row per card: a title, the update date and the download links up to the next title.

    Cards without a date or a link are no publications. The page is cut at its titles inside its
    row, so nothing is shuffled. ``bare_names`` is that of `html_clean`.
    """
    marked = F.regexp_replace(
        X.html_clean(F.col("html"), bare_names), f"(?i)({title_pattern})", f"{_MARK}$1"
    )
    cards = pages.select(
        "page_id", F.posexplode(F.slice(F.split(marked, _MARK), 2, 1 << 30)).alias("card_no", "card")
    )
    links = F.regexp_extract_all("card", F.lit(f"(?i){link_pattern}"), F.lit(1))
    fields = F.struct(
        X.strip(F.regexp_extract("card", f"(?i)^{title_pattern}", 1)).alias("title"),
        X.parse_us_date(F.col("card")).alias("updated_date"), links.alias("links"),
    )
    found = cards.select("page_id", "card_no", X.computed_once(fields).alias("f")).select(
        "page_id", "card_no", "f.*"
    ).where("updated_date IS NOT NULL AND size(links) > 0")
    title = F.col("title")
    return found.select(
        "page_id", "card_no", title, "updated_date",
        X.slug_document_id(F.lit(ticker), title, F.col("updated_date"), id_prefix).alias(
            "source_document_id"
        ),
        X.map_document_type(title).alias("document_type"),
        X.map_scope(title).alias("scope"), X.map_audit_status(title).alias("audit_status"),
        F.transform("links", lambda link: F.struct(
            X.filename_from_download_url(link).alias("filename"),
            F.concat(F.lit(host), link).alias("download_reference"),
            F.lit("application/pdf").alias("reported_mime_type"),
        )).alias("attachments"),
    )
